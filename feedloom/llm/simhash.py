"""Near duplicates by SimHash: 64-bit fingerprints of word shingles, linked at few differing bits.

The index lists positional bytes. Two fingerprints of 8 bytes that differ in at most
``max_bits`` bits differ in at most ``max_bits`` bytes, so they share at least
``8 - max_bits`` positional bytes: the guaranteed minimum of matches. A list is kept
for each set of that many positional bytes, so whatever meets in a list has reached
the minimum, and nothing else is counted. What meets is verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from feedloom.llm.common import modest, saved, slices, spread_join, utf8
from feedloom.llm.components import stars

#: A list with more fingerprints is cut into parts of this size, compared pair by pair in tasks of their own.
PART = 1 << 16
_BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """A bit is 1 if it is set in over half of the shingles' XXH64 (seed 42); 0 without words."""
    words = text.lower().split()  # of bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths) + np.arange(len(words))
    starts = (ends - lengths)[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    tally = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        values = [hashed(joined[a:b], 42) for a, b in zip(starts[at:at + _BLOCK], ends[at:at + _BLOCK])]
        bits = np.unpackbits(np.array(values, ">u8").view(np.uint8)).reshape(-1, 64)
        tally += bits.sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * tally > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 4) -> DataFrame:
    """(id, text_key, fingerprint) of each row; text_key tells texts apart that share an id."""
    rows = modest(docs).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"),
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 24):
                found = np.array([fingerprint(t, shingle) for t in utf8(part.column(2))], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found)], ["id", "text_key", "fingerprint"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(of, f"id {kind}, text_key long, fingerprint long")


def _masks(max_bits: int) -> list[int]:
    """The sets of positional bytes that make a list, as bit masks."""
    masks = (sum(0xFF << 8 * place for place in places) for places in combinations(range(8), 8 - max_bits))
    return [mask - (1 << 64) if mask >> 63 else mask for mask in masks]


def _forest(values: np.ndarray, max_bits: int) -> tuple[list[int], list[int]]:
    """Links that connect what is linked within ``values``: fewer than there are values.

    A value is compared with those not reached yet, so in a dense group most need few comparisons.
    """
    left, right, rest = [], [], values.view(np.uint64)  # bits of negative numbers are those of their absolute value
    while len(rest) > 1:
        waiting, rest = [rest[0]], rest[1:]
        while waiting and len(rest):
            near = np.bitwise_count(rest ^ waiting[-1]) <= max_bits
            value = waiting.pop()
            if near.any():
                reached = rest[near]
                left += [int(value.view(np.int64))] * len(reached)
                right += reached.view(np.int64).tolist()
                waiting += list(reached)
                rest = rest[~near]
    return left, right


def _links(a: list[int], b: list[int], parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    keys, numbers, blobs = zip(*parts) if parts else ((), (), ())
    none = [None] * len(a)
    return pa.RecordBatch.from_arrays([
        pa.array(a + [None] * len(parts), pa.int64()), pa.array(b + [None] * len(parts), pa.int64()),
        pa.array(none + list(keys), pa.int64()), pa.array(none + list(numbers), pa.int32()),
        pa.array(none + list(blobs), pa.binary()),
    ], ["a", "b", "list", "part", "members"])


def _read_lists(max_bits: int, size: int):
    """Rows (list, fingerprint) in order of list -> links, and the parts of lists longer than ``size``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, number = None, np.zeros(0, np.int64), 0
        for batch in batches:
            keys, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(keys):
                continue
            a, b, parts = [], [], []

            def close(part: bool) -> None:
                nonlocal held, number
                if len(held) > 1:
                    left, right = _forest(held, max_bits)
                    a.extend(left)
                    b.extend(right)
                if (part or number) and len(held):
                    parts.append((key, number, held.tobytes()))
                    number += 1
                held = held[:0]

            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            first = edges[0] if len(edges) else len(keys)
            if key != keys[0]:
                close(False)
                key, number = int(keys[0]), 0
            # The first and the last list of a batch may go on in another; single rows between them have no partner.
            runs = [(0, first)]
            if len(edges):
                to = np.append(edges[1:], len(keys))
                many = (to - edges > 1) | (to == len(keys))
                runs += zip(edges[many].tolist(), to[many].tolist())
            for start, end in runs:
                if start:
                    close(False)
                    key, number = int(keys[start]), 0
                for at in range(start, end, size):
                    held = np.concatenate([held, values[at:min(at + size, end)]])
                    while len(held) > size:
                        rest, held = held[size:], held[:size]
                        close(True)
                        held = rest
            if a or parts:
                yield _links(a, b, parts)
        a, b, parts = [], [], []
        if len(held) > 1:
            a, b = _forest(held, max_bits)
        if number and len(held):
            parts.append((key, number, held.tobytes()))
        if a or parts:
            yield _links(a, b, parts)
    return read


def _read_pairs(max_bits: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                left, right = _forest(np.unique(np.frombuffer(x + y, np.int64)), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
    return read


def links(marks: DataFrame, max_bits: int = 4, part: int = PART) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints ``marks`` (column fingerprint) to connect
    what is connected by pairs that differ in at most ``max_bits`` bits, 7 at most."""
    if not 0 <= max_bits < 8:
        raise ValueError("max_bits must be 0 to 7: beyond it no positional byte need be shared")
    listed = marks.select(
        "fingerprint", F.explode(F.array(*[F.lit(mask).cast("long") for mask in _masks(max_bits)])).alias("mask"),
    ).select(
        F.xxhash64("mask", F.col("fingerprint").bitwiseAND(F.col("mask"))).alias("list"), "fingerprint")
    shuffled = listed.repartition("list").sortWithinPartitions("list")
    found = saved(
        shuffled.mapInArrow(_read_lists(max_bits, part), "a long, b long, list long, part int, members binary"),
        "simhash-lists",
    )
    parts = found.where("members IS NOT NULL").select("list", "part", "members")
    pairs = (
        parts.alias("x").join(parts.alias("y"), "list").where("x.part < y.part")
        .select(F.col("x.members").alias("x"), F.col("y.members").alias("y"))
        .repartition(F.xxhash64("x", "y")).mapInArrow(_read_pairs(max_bits), "a long, b long")
    )
    return found.where("a IS NOT NULL").select("a", "b").union(pairs)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 4, max_bits: int = 4,
) -> DataFrame:
    """(id, text_key, fingerprint, component, component_id) of each row of ``docs``.

    Null text counts as empty; without words the fingerprint is 0, which links like any other. Fewer words
    than ``shingle`` make one shingle. ``component`` is the same number for all that are connected,
    ``component_id`` the least id among them (null ids do not count, it is null if there is no other).
    Repeated rows give repeated rows. Columns other than the two named are not read.
    """
    marked = saved(fingerprints(docs, id_col, text_col, shingle), "simhash")
    marks = saved(marked.groupBy("fingerprint").agg(F.min("id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
    rooted = stars(links(marks.select("fingerprint"), max_bits))
    placed = saved(marks.join(rooted, marks.fingerprint == rooted.a, "left").select(
        "fingerprint", "least", "n", F.coalesce("b", "fingerprint").alias("component")), "simhash-placed")
    heads = saved(placed.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n")), "simhash-heads")
    # A component may have any share of the fingerprints, a fingerprint any share of the rows.
    told = saved(spread_join(placed.select("fingerprint", "component", F.col("n").alias("rows")), heads, ["component"]), "simhash-told")
    return spread_join(marked, told.withColumnRenamed("rows", "n"), ["fingerprint"]) \
        .select("id", "text_key", "fingerprint", "component", "component_id")


def hex_of(column: str):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one of each component: the least id, among equal ids the least hash of the text.

    Null ids come last. Of rows of equal id and text the least stays, by all columns in their order, nulls first, so columns must be
    of kinds that can be ordered. All columns stay, whatever their names. An empty table gives no rows.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_key")
    keep = found.groupBy("component").agg(F.min(order).alias("head")).select("head.*")
    packed = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.struct("*").alias("row"))
    # Keys without nulls, so that the join and what drops repeated rows are dealt alike: rows are shuffled once.
    kind, key = docs.schema[id_col].dataType, ["none", "known", "text_key"]

    def keyed(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(
            F.col("id").isNull().alias("none"), F.coalesce("id", F.lit("0").cast(kind)).alias("known"), "text_key", *columns)

    return keyed(packed, "row").join(keyed(keep), key, "left_semi").groupBy(*key).agg(F.min("row").alias("row")).select("row.*")
