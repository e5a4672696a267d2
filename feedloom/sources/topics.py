"""Topics of JSON messages: read them, and publish records to them.

A topic is a Kafka topic, or, with a ``path``, a directory of Parquet files with
the columns a Kafka source delivers. Both can be read as a table or as a stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from feedloom.schemas import ENVELOPE
from feedloom.sinks.batches import batch_folder


def read_topic(
    spark: SparkSession,
    topics: str | Sequence[str],
    *,
    path: str | None = None,
    stream: bool = True,
    options: Mapping[str, str] | None = None,
    with_batch: bool = False,
) -> DataFrame:
    """Messages of one or more topics from the start; a checkpointed stream resumes instead.

    ``options`` go to the reader, e.g. ``kafka.bootstrap.servers``,
    ``maxOffsetsPerTrigger`` or, for files, ``maxBytesPerTrigger``. Of a topic of files
    ``with_batch`` also tells the ``run`` and ``batch_id`` that published a message.
    """
    topics = [topics] if isinstance(topics, str) else list(topics)
    reader = spark.readStream if stream else spark.read
    if path is None:
        return (
            reader.format("kafka").option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest").options(**(options or {})).load()
        )
    # A stream heeds basePath, which makes "topic" a column, only where the path is a glob.
    names = "{" + ",".join(topics) + "}"
    written = [f for f in ENVELOPE.fields if f.name not in ("partition", "offset")]
    folders = T.StructType([*written, T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())])
    # Where a message stands: in which of a publishing job's tasks, and in which file and row of that task.
    name = F.col("_metadata.file_name")
    task = F.regexp_extract(name, r"^part-(\d+)", 1).cast("int")
    file = F.coalesce(F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("long"), F.lit(0))
    return (
        reader.schema(folders).options(**(options or {})).option("basePath", path)
        .parquet(f"{path}/topic={names}")
        .withColumns({"partition": task, "offset": F.shiftleft(file, 40) + F.col("_metadata.row_index")})
        .select(*ENVELOPE.fieldNames(), *(["run", "batch_id"] if with_batch else []))
    )


def as_messages(records: DataFrame, topic: str) -> DataFrame:
    """One message per record: null key, the record as UTF-8 JSON; null fields are written."""
    value = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    return records.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
    )


def publish(
    records: DataFrame,
    topic: str,
    *,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    batch_id: int = 0,
    run: str | None = None,
) -> None:
    """Append the records to a topic; returns when all are written.

    For a stream of records call it from ``foreachBatch``. ``options`` go to the
    writer, e.g. ``kafka.bootstrap.servers`` or ``maxRecordsPerFile``. In files, a batch
    that is published again under its ``run`` and ``batch_id`` replaces itself; a stream
    that has read it already sees its messages again, as it would from a broker.
    """
    messages = as_messages(records, topic)
    if path is None:
        messages.write.format("kafka").options(**(options or {})).save()
    else:
        (
            messages.select("key", "value", F.current_timestamp().alias("timestamp"))
            .write.mode("overwrite").options(**(options or {}))
            .parquet(batch_folder(f"{path}/topic={topic}", batch_id, run or uuid.uuid4().hex))
        )
