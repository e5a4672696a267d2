"""Summary of one numeric column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def scaled(df: DataFrame, column: str, factor: int, *, null_on_overflow: bool = False) -> DataFrame:
    """Replace a column by its product with ``factor``; overflow raises under ANSI mode, or gives NULL if asked to."""
    product = F.try_multiply(F.col(column), F.lit(factor)) if null_on_overflow else F.col(column) * factor
    return df.withColumn(column, product)


def numeric_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: non-null count, mean and sample standard deviation."""
    c: Column = F.col(column)
    return df.agg(
        F.count(c).alias("count"), F.mean(c).alias("mean"), F.stddev(c).alias("stddev")
    )
