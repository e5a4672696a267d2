"""What the operators share: tables, the shared folder, text columns as byte arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.functions.batches import modest  # noqa: F401  the operators take it from here


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local session may go without the setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="feedloom-llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/feedloom-llm/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, lost executors cost nothing before it."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """Like ``saved``, dealt by ``key`` into files, so that whatever joins or groups by it needs no shuffle of these rows.

    The catalog gets a table of a name of its own, whose files are in the shared folder.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    table = f"feedloom_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    (
        df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).format("parquet")
        .option("compression", "zstd").option("path", path).saveAsTable(table)
    )
    return spark.table(table)


def spread_join(rows: DataFrame, one: DataFrame, key: list[str], share: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``one``, which has one row for each key and in ``n`` the rows of that key at least.

    Keys on more than a ``share``-th of all, of which there are fewer than ``share``, are broadcast, and their rows stay where they
    are; the others are joined. So no key's rows have to meet in one task. Rows without a key in ``one`` go. Both sides are read
    twice. Keys are not null.
    """
    total = one.agg(F.sum("n")).head()[0] or 0
    is_hot = F.col("n") * share > total
    columns = [name for name in one.columns if name not in (*key, "n")]
    few = F.broadcast(one.where(is_hot).select(*key, F.struct(*columns).alias("_hot")))
    beside = rows.join(few, key, "left")
    near = beside.where("_hot IS NOT NULL").select(*rows.columns, "_hot.*")
    far = beside.where("_hot IS NULL").drop("_hot").join(one.where(~is_hot).drop("n"), key)
    return near.unionByName(far.select(*rows.columns, *columns))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all values, n + 1 offsets); null counts as empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have ``limit`` bytes at most, or a single row."""
    if not batch.num_rows:
        return
    offsets = bytes_of(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def utf8(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def strings(column: pa.Array) -> list[str]:
    return pc.fill_null(column, "").to_pylist()
