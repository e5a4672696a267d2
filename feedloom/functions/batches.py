"""The size of what Spark hands to Python."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def modest_batches(spark: SparkSession, size: str = "8m") -> None:
    """Rows go to Python in batches of about ``size`` from now on, whatever the length of their values."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def modest(df: DataFrame, size: str = "8m") -> DataFrame:
    """``modest_batches`` for the session of ``df``."""
    modest_batches(df.sparkSession, size)
    return df
