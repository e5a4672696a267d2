"""Token ids in files: frequency ranks, one to four bytes each, lengths in control bytes of their own.

A file holds the documents of one stretch of ids in ascending order and needs no
other file to be read:

    4 bytes  magic
    u32 u64 u32   documents, ids, size of the rank table
    u32[]    rank table: the id of each rank, the most frequent id first
    i64[]    document ids;   u8[]  1 where a document id is null;   u32[]  ids of each document
    u8[]     control bytes: four codes of two bits, the bytes of a rank less one
    u8[]     data bytes: the ranks, least byte first, without their leading zero bytes
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from feedloom.llm.common import modest, saved, scratch, slices, strings
from feedloom.llm.tokens import encoder

MAGIC = b"FLT1"
_HEAD = struct.Struct("<4sIQI")
#: Ids in a file, about; more go to the stretch's next file.
FILE_IDS = 1 << 20

#: For each control byte the lengths of its four values.
_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def encode(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file of the documents, whose ids stand one after another in ``ids``."""
    if len(ids):
        counts = np.bincount(ids)
        table = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)].astype("<u4")
        rank_of = np.zeros(len(counts), "<u4")
        rank_of[table] = np.arange(len(table))
        ranks = rank_of[ids]
    else:
        table = ranks = np.zeros(0, "<u4")
    # No rank needs more bytes than the last.
    width = max(1, -(-max(0, len(table) - 1).bit_length() // 8))
    code = np.zeros(len(ranks), np.uint8)
    for place in range(1, width):
        code += ranks >= 1 << 8 * place
    fours = np.zeros((-(-len(code) // 4), 4), np.uint8)
    fours.reshape(-1)[:len(code)] = code
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    written = code[:, None] >= np.arange(width, dtype=np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[:, :width].reshape(-1)[written.reshape(-1)]
    none = np.array([x is None for x in doc_ids], np.uint8)
    return b"".join([
        _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(table)), table.tobytes(),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), none.tobytes(), lengths.astype("<u4").tobytes(),
        control.tobytes(), data.tobytes(),
    ])


def decode(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, ids of each, all ids) of a file."""
    magic, docs, total, ranks = _HEAD.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(content, kind, count, at)
        at += values.nbytes
        return values

    table = take("<u4", ranks)
    doc_ids, none, lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
    sizes = _LENGTHS[take("u1", -(-total // 4))].reshape(-1)[:total]
    data = take("u1", len(content) - at)
    ends = np.cumsum(sizes, dtype=np.int64)
    starts = ends - sizes
    if total and ends[-1] != len(data) or int(lengths.sum()) != total:
        raise ValueError("token file is cut short")
    found = data[starts].astype(np.uint32) if total else np.zeros(0, np.uint32)
    wide = np.flatnonzero(sizes > 1)
    for place in range(1, 4):
        wide = wide[sizes[wide] > place] if place > 1 else wide
        found[wide] |= data[starts[wide] + place].astype(np.uint32) << np.uint32(8 * place)
    return [None if n else d for d, n in zip(doc_ids.tolist(), none)], lengths, table[found]


def _put(folder: str, name: str, content: bytes) -> None:
    """Write under another name, then rename: a reader never sees half a file, a repeated task replaces its own."""
    system, path = fs.FileSystem.from_uri(folder)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(content)
    system.move(part, f"{path}/{name}")


def _writer(path: str, folder: str, end_id: int, file_ids: int, added: bool):
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, stretch, number = encoder(path, kept=800_000, added=added), TaskContext.get().partitionId(), 0
        docs, held, size = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, held, size, number
            name = f"{stretch:08}-{number:08}.tokens"
            _put(folder, name, encode(docs, np.array([len(x) // 4 for x in held]), np.frombuffer(b"".join(held), "<u4")))
            row = pa.RecordBatch.from_pydict({"file": [name], "docs": [len(docs)], "ids": [size]})
            docs, held, size, number = [], [], 0, number + 1
            return row

        for batch in batches:
            for part in slices(batch, 1, 1 << 22):
                for doc, ids in zip(part.column(0).to_pylist(), library.encode(strings(part.column(1)))):
                    docs.append(doc)
                    held.append(ids + end)
                    size += len(held[-1]) // 4
                    if size >= file_ids:
                        yield flush()
        if docs:
            yield flush()
    return write


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
    end_id: int = 2, file_ids: int = FILE_IDS, added: bool = False,
) -> DataFrame:
    """Write every document's ids, ``end_id`` last, to ``folder`` in ascending order of id; (file, docs, ids) of each file.

    Files are in the order of their names. Null ids come first, equal ids in the order of their texts' hashes; null text
    counts as empty. The ids must be integers. Only texts are shuffled, once; ids go straight from the tokenizer
    to the file. ``added`` is that of ``tokens.Encoder``.
    """
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)
    rows = modest(docs).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    # Rows that share an id, null too, are spread by their texts.
    return saved(
        rows.repartitionByRange("id", "text_key").sortWithinPartitions("id", "text_key", "text").drop("text_key")
        .mapInArrow(_writer(tokenizer, folder, end_id, file_ids, added), "file string, docs long, ids long"),
        "token-files",
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            doc_ids, lengths, ids = decode(content.as_buffer())
            ends = np.cumsum(lengths, dtype=np.int64)
            ids = ids.astype("<u4")
            crc = [zlib.crc32(ids[b - n:b]) for b, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * len(doc_ids)), pa.array(doc_ids, pa.int64()), pa.array(ends - lengths),
                pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64()),
            ], ["file", "id", "place", "n_tokens", "ids_crc32"])


def read_tokens(folder: str, files: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document in the files that ``write_tokens`` told of."""
    content = (
        files.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )
    # A file's stretch is in its name: stretches are summed up first, then the files of each.
    stretch = F.substring_index("file", "-", 1)
    sums = files.groupBy(stretch.alias("stretch")).agg(F.sum("ids").alias("ids"))
    sums = sums.select("stretch", F.coalesce(F.sum("ids").over(Window.orderBy("stretch").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"))
    before = files.withColumn("stretch", stretch).select("file", "stretch", F.coalesce(F.sum("ids").over(
        Window.partitionBy("stretch").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("within")
    ).join(sums, "stretch").select("file", (F.col("earlier") + F.col("within")).alias("before"))
    found = content.mapInArrow(_read, "file string, id long, place long, n_tokens long, ids_crc32 long")
    return found.join(before, "file").select(
        "id", (F.coalesce("before", F.lit(0)) + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write ``docs`` to a new folder below the shared one and read them back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read_tokens(folder, write_tokens(docs, folder, tokenizer, **options))
