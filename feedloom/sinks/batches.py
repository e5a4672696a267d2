"""Append-only target for micro-batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom.functions.once import with_once
from feedloom.operators.validity import reasons


def batch_folder(path: str, batch_id: int, run: str) -> str:
    return f"{path}/run={run}/batch_id={batch_id}"


def append_sink(path: str, rules: Mapping[str, Column] | None = None):
    """Sink for ``runs.start``: each micro-batch is a folder that a replay replaces.

    With ``rules``, or for a stream that ``validity.tagged`` has marked, rows that break one are
    kept as of kind "rejected" with their reasons, the others as "rows". Both are written in one pass.
    """
    def write(batch: DataFrame, batch_id: int, run: str) -> None:
        if rules:
            batch = with_once(batch, "reasons", reasons(rules))
        kind = F.lit("rows")
        if "reasons" in batch.columns:
            kind = F.when(F.size("reasons") > 0, "rejected").otherwise("rows")
        batch.withColumn("kind", kind).write.mode("overwrite").partitionBy("kind").parquet(
            batch_folder(path, batch_id, run))
    return write


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "rows"
) -> DataFrame:
    """All rows appended so far, with ``run`` and ``batch_id``; none before the first batch."""
    full = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    full = full.add("run", T.StringType()).add("batch_id", T.LongType()).add("kind", T.StringType())
    try:
        return spark.read.schema(full).parquet(path).filter(F.col("kind") == kind).drop("kind")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full).drop("kind")
