"""The latest row of each key, kept as the state of an aggregation over a stream.

The state store is the table: a batch updates the keys it holds, a checkpoint makes that count once, and
``latest_rows`` reads the store as any other source. Nothing else is written, unless the rows that a batch
has changed go on to a sink, such as a database that replaces rows by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from feedloom.live import runs
from feedloom.operators.latest import latest_per_key


def keep_latest(
    rows: DataFrame,
    query: str,
    key: str,
    order_by: Sequence[str],
    *,
    target: str,
    checkpoint_root: str,
    sink: runs.BatchSink | None = None,
    every: str | None = None,
    available_now: bool = False,
):
    """Start a query that keeps the row with the greatest ``order_by`` of each key of a stream.

    Ties fall to the remaining columns, so any split into batches and any replay ends in the same state. A key of
    NULL is a key like others; filter such rows before. A batch sends one row a key to the shuffle at most. ``sink`` gets the
    changed rows of each batch and must use all of them. The number of state's parts is ``spark.sql.shuffle.partitions`` at the first
    start; with many keys let the session's state store be RocksDB's, which keeps
    them on disk.
    """
    return runs.start(
        latest_per_key(rows, key, order_by), query, sink, target=target, checkpoint_root=checkpoint_root,
        every=every, available_now=available_now, output_mode="update")


def latest_rows(
    spark: SparkSession, checkpoint_root: str, query: str, schema: T.StructType | str, key: str, order_by: Sequence[str],
) -> DataFrame:
    """The rows that ``keep_latest`` holds after its last finished batch; none before the first."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    try:
        state = spark.read.format("statestore").load(f"{checkpoint_root}/{query}/progress")
    except PySparkException as error:
        if error.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return spark.createDataFrame([], schema)
    kept = state.select(F.col(f"key.{key}").alias(key), F.col("value.*"))
    row = kept.columns[-1]
    return kept.select(*[
        F.col(name) if name == key else F.col(f"{row}.{name}").alias(name) for name in names])
