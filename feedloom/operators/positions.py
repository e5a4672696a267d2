"""Numbering rows without sending them all to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def store_numbered(df: DataFrame, order_by: Sequence[str], path: str, name: str = "position") -> DataFrame:
    """``df`` with gapless numbers from 0 in the order of ``order_by``, read back from the Parquet files at ``path``.

    Rows are sorted by ranges; only each range's number of rows is summed up. NULLs come first; rows that tie
    stand in any order, which is kept since the files are written. The files are in the order of the numbers, so a
    condition on them reads few row groups.
    """
    spark, at = df.sparkSession, f"_{name}_at"
    df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn(
        at, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    ranges = rows.groupBy(F.shiftright(at, 33).alias("_range")).agg(F.count("*").alias("n"), F.min(at).alias("first"))
    before = F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    # One row a range of the sort, of which there are as many as shuffle partitions.
    shift = F.broadcast(ranges.select("_range", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_shift")))
    return rows.join(shift, F.shiftright(at, 33) == F.col("_range")).select(
        *df.columns, (F.col(at) + F.col("_shift")).alias(name))
