"""Document fingerprints: the k least hashes of a text's word shingles.

Sketches of parts merge to the sketch of the whole, and estimate how alike two
texts are, how much of one is in the other, and how many shingles there are.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from feedloom.llm import words
from feedloom.llm.common import bytes_of, modest, saved, slices, utf8

K = 128
SHINGLE = 5
#: Hashes are cut to 48 bits, 6 bytes each.
_BITS = 48


def sketches(data: np.ndarray, offsets: np.ndarray, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The sketch of each text: ascending distinct hashes, ``k`` at most.

    Words stand between ASCII white space, A-Z count as a-z. Fewer words than ``shingle`` make one shingle, none none.
    """
    starts, ends, first = words.spans(data, offsets, words.SPACED)
    hashed = words.hashes(data, starts, ends)
    joined = hashed
    for step in range(1, shingle):
        joined = words.chained(joined[:-1], hashed[step:])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= shingle:
            found = joined[a:b - shingle + 1]
        else:
            found = hashed[a:min(a + 1, b)]
            for place in range(a + 1, b):
                found = words.chained(found, hashed[place:place + 1])
        found = found >> np.uint64(64 - _BITS)
        if len(found) > 8 * k:
            # Repeats may be among the least, so the cut is widened until enough distinct ones are below it.
            size = 4 * k
            least = np.unique(np.partition(found, size)[:size])
            while len(least) < k and size < len(found):
                size = min(4 * size, len(found))
                least = np.unique(np.partition(found, size - 1)[:size])
            found = least
        out.append(np.unique(found)[:k])
    return out


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all of two texts; exact up to ``k`` shingles, 1 for two without any."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(both))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) + 1) * 2.0 ** _BITS


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first text's shingles that are in the second."""
    size = distinct(a, k)
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / size) if size else 1.0


def packed(sketch: np.ndarray) -> bytes:
    return sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(content: bytes) -> np.ndarray:
    wide = np.zeros((len(content) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(content, np.uint8).reshape(-1, 6)
    return wide.view(">u8").ravel().astype(np.uint64)


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """(id, sketch) of each row; null text counts as empty, repeated rows come out each."""
    rows = modest(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 22):
                found = sketches(*bytes_of(part.column(1)), k, shingle)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(packed, found), pa.binary())], ["id", "sketch"])

    return rows.mapInArrow(read, f"id {rows.schema['id'].dataType.simpleString()}, sketch binary")


def merged(parts: DataFrame, key_col: str, sketch_col: str = "sketch", *, k: int = K) -> DataFrame:
    """(key, sketch): the sketch of everything under a key. A task sends one sketch a key, however many it has."""
    rows = parts.select(F.col(key_col).alias("key"), F.col(sketch_col).alias("sketch"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for key, sketch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = unpacked(sketch or b"")
                held[key] = merge(held[key], new, k) if key in held else new
            if len(held) > 1 << 16:
                yield flush(held, batch.schema)
                held = {}
        if held:
            yield flush(held, rows_schema)

    def flush(held: dict, schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held, schema.field(0).type), pa.array(map(packed, held.values()), pa.binary())], ["key", "sketch"])

    from pyspark.sql.pandas.types import to_arrow_schema

    rows_schema = to_arrow_schema(rows.schema)
    kind = f"key {rows.schema['key'].dataType.simpleString()}, sketch binary"
    return rows.mapInArrow(fold, kind).repartition("key").sortWithinPartitions("key").mapInArrow(fold, kind)


def edited(text: str, after: str) -> str:
    """The last half of the characters replaced by the first as many, or all, of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


_ROW = ["id", "n_chars", "edited_sha256", "sketch", "edited_sketch", "near_edited", "near_next"]
#: Stretches of the order of ids for each shuffle partition.
STRETCHES = 4


def _beside(texts: list[bytes], k: int, shingle: int) -> list[tuple]:
    """A row for each text but the last, held against the next."""
    changed = [edited(a.decode(), b.decode()).encode() for a, b in zip(texts, texts[1:])]
    own = sketches(*bytes_of(pa.array(texts, pa.binary())), k, shingle)
    other = sketches(*bytes_of(pa.array(changed, pa.binary())), k, shingle)
    return [
        (len(text.decode()), hashlib.sha256(new).hexdigest(), packed(a), packed(b), resemblance(a, b, k), resemblance(a, after, k))
        for text, new, a, b, after in zip(texts, changed, own, other, own[1:])
    ]


def _rows(ids: pa.Array, found: list[tuple]) -> list[pa.Array]:
    columns = list(zip(*found)) if found else [()] * 6
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64())
    return [ids, *[pa.array(values, kind) for values, kind in zip(columns, kinds)]]


def _stretched(firsts: list[tuple]):
    """Rows (id, text_key, text) -> with their stretch; the first of a stretch also goes to the one before, as what follows its last."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [(i is not None, i, k) if i is not None else (False, k) for i, k in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            stretch = [bisect_right(firsts, place) - 1 for place in places]
            again = [n for n, (place, at) in enumerate(zip(places, stretch)) if firsts[at] == place]
            rows = pa.array([*range(batch.num_rows), *again], pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array([*stretch, *[(stretch[n] - 1) % len(firsts) for n in again]], pa.int32()),
                pa.array([False] * batch.num_rows + [True] * len(again)), *[column.take(rows) for column in batch.columns],
            ], ["stretch", "follows", *batch.schema.names])
    return deal


def _walk(k: int, shingle: int):
    """Rows (stretch, follows, id, text) in order -> a row for each that does not follow, held against the next."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, ended, held = None, False, None
        for batch in batches:
            for part in slices(batch, 3, 1 << 21):
                at = part.column(0).to_numpy()
                edges = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), part.num_rows]
                for a, b in zip(edges, edges[1:]):
                    run = part.slice(a, b - a).select(["follows", "id", "text"])
                    if at[a] != stretch:
                        stretch, ended, held = at[a], False, None
                    if ended:
                        continue
                    # One of what follows is enough, the others are its copies.
                    run = run.slice(0, pc.index(run.column(0), True).as_py() + 1 or run.num_rows)
                    if held is not None:
                        run = pa.Table.from_batches([held, run]).combine_chunks().to_batches()[0]
                    found = _beside(utf8(run.column(2)), k, shingle)
                    if found:
                        yield pa.RecordBatch.from_arrays(_rows(run.column(1).slice(0, len(found)), found), _ROW)
                    ended = run.column(0)[run.num_rows - 1].as_py()
                    # A copy, so that the rest of the batch can go.
                    held = run.take(pa.array([run.num_rows - 1]))
    return walk


def compared_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, k: int = K, shingle: int = SHINGLE,
) -> DataFrame:
    """Each text's sketch beside that of its edited form and of the next text, in ascending order of id.

    (id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next). After the last comes the first;
    null ids come first, equal ids in the order of their texts' hashes, null text counts as empty, repeated rows come out each.
    Texts are shuffled once, by stretches of that order: what begins a stretch is known before, one row each, so that it is
    sent along to the stretch before. An id on any share of the rows is in several stretches.
    """
    rows = modest(docs).select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")) \
        .select("id", F.xxhash64("text").alias("text_key"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    count = STRETCHES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.select("id", "text_key").repartitionByRange(count, "id", "text_key")
    least = saved(ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct("id", "text_key")).alias("least")), "sketch-ranges")
    # ``count`` rows at most.
    firsts = sorted({(True, r.id, r.text_key) if r.id is not None else (False, r.text_key) for r in least.select("least.*").collect()})
    if not firsts:
        return docs.sparkSession.createDataFrame([], f"id {kind}, {_FOUND}")
    dealt = rows.mapInArrow(_stretched(firsts), f"stretch int, follows boolean, id {kind}, text_key long, text string")
    return (
        dealt.repartition("stretch").sortWithinPartitions("stretch", "follows", "id", "text_key").drop("text_key")
        .mapInArrow(_walk(k, shingle), f"id {kind}, {_FOUND}"))


_FOUND = "n_chars long, edited_sha256 string, sketch binary, edited_sketch binary, near_edited double, near_next double"
