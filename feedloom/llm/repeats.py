"""Repeated passages: words of a corpus that lie in a window of words which also starts earlier.

Anchors are the non-overlapping blocks of half a window's words of each text. A window, wherever it starts, holds one
of them whole. Every rolling block of every text probes the anchors; an anchor that also occurs elsewhere is a hit.
Hits are extended on both sides to the windows that hold them: these are held against each other whole, as 96-bit
hashes, and the windows that occur earlier, overlapping or touching, make up the maximal repeats.

Texts lie in chunks, written once. A chunk tells a block or a window once to the shard of its hash, with its first
place, however often it holds it, so a passage in a third of all texts costs a row a chunk. Shards answer a bit each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from feedloom.llm import words
from feedloom.llm.coding import ascending, planes, ranges, reascending, unplanes, within
from feedloom.llm.common import bytes_of, modest, saved, slices

#: Bytes of text in a chunk, or one longer text.
CHUNK = 1 << 22
#: Words of the corpus for each shard, about.
SHARD = 1 << 22

_SECOND = np.uint64(0xA0761D6478BD642F)
_ANSWER = "stage int, chunk long, shard int, told binary"


def rolling(hashed: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` words that follow each other."""
    if size == 1:
        return hashed
    half = size // 2
    part = rolling(hashed, half)
    out = words.chained(part[:max(0, len(part) - half)], part[half:])
    return words.chained(out[:max(0, len(out) - 1)], hashed[size - 1:]) if size % 2 else out


@dataclass
class Texts:
    """The words of a chunk's texts; each row is a word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    ids: pa.Array

    @staticmethod
    def of(row: dict, ids: pa.Array) -> Texts:
        data = np.frombuffer(zstandard.decompress(row["content"]), np.uint8)
        offsets = np.concatenate([[0], np.cumsum(unplanes(row["lengths"], "<u4"), dtype=np.int64)])
        return Texts(data, *words.spans(data, offsets, words.SPACED), ids)

    def looked_at(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, place in its text, words from it to the text's end) of each word; texts without a window end at once."""
        size = np.diff(self.first)
        left = np.repeat(np.where(size >= window, size, 0), size)
        place = np.arange(len(self.starts)) - np.repeat(self.first[:-1], size)
        return words.hashes(self.data, self.starts, self.ends, words.AS_WRITTEN), place, left - np.where(left > 0, place, 0)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) -> a row for each chunk."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0

    def chunk() -> pa.RecordBatch:
        nonlocal number
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        data, offsets = bytes_of(rows.column(1))
        out = pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(0)),
            pa.array([planes(np.diff(offsets).astype("<u4"))]), pa.array([zstandard.compress(data.tobytes(), 3)]),
            pa.array([len(words.spans(data, offsets, words.SPACED)[0])], pa.int64()),
        ], ["chunk", "ids", "lengths", "content", "words"])
        number += 1
        return out

    for batch in batches:
        for part in slices(batch, 1, CHUNK):
            weight = len(bytes_of(part.column(1))[0])
            if held and size + weight > CHUNK:
                yield chunk()
                held, size = [], 0
            held.append(part)
            size += weight
    if held:
        yield chunk()


class _Anchors:
    """The blocks of a chunk's texts, and its anchors by their distinct hashes."""

    def __init__(self, texts: Texts, window: int, shards: int):
        self.window, self.shards = window, shards
        self.hashed, place, self.left = texts.looked_at(window)
        block = window // 2
        self.probe = rolling(self.hashed, block)
        self.inside = self.left[:len(self.probe)] >= block
        self.at = np.flatnonzero(self.inside & (place[:len(self.probe)] % block == 0))
        self.anchors = np.unique(self.probe[self.at])
        self.spans = ranges(self.anchors, shards)

    def _short(self, values: np.ndarray, shard: int) -> np.ndarray:
        return within(values, shard, self.shards, 32).astype("<u4")

    def questions(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """(shard, anchors, whether each is here twice, other blocks). Two blocks told alike are extended in vain at worst."""
        every = np.sort(self.probe[self.inside])
        again = every[1:] == every[:-1]
        twice = np.isin(self.anchors, every[1:][again])
        others = every[np.concatenate([np.ones(min(1, len(every)), bool), ~again])]
        others = others[~np.isin(others, self.anchors, assume_unique=True)]
        own, rest = ({k: (a, b) for k, a, b in spans} for spans in (self.spans, ranges(others, self.shards)))
        for shard in sorted({*own, *rest}):
            (a, b), (c, d) = own.get(shard, (0, 0)), rest.get(shard, (0, 0))
            yield (shard, ascending(self._short(self.anchors[a:b], shard)), np.packbits(twice[a:b]).tobytes(),
                   ascending(self._short(others[c:d], shard)))

    def candidates(self, told: dict[int, bytes]) -> np.ndarray:
        """Starts of the windows whose first anchor is a hit."""
        hit = np.zeros(len(self.anchors), bool)
        for shard, a, b in self.spans:
            hit[a:b] = np.unpackbits(np.frombuffer(told[shard], np.uint8), count=b - a)
        # From behind the anchor before up to the anchor. With a window's words left it is in the same text.
        at = self.at[hit[np.searchsorted(self.anchors, self.probe[self.at])]]
        starts = (at[:, None] - np.arange(self.window // 2 - 1, -1, -1)).ravel()
        starts = starts[starts >= 0]
        return np.sort(starts[self.left[starts] >= self.window])


class _Windows:
    """The windows of a chunk that hold a hit: what it tells the shards, and which are repeats once they have answered."""

    def __init__(self, texts: Texts, window: int, shards: int, told: dict[int, bytes]):
        blocks = _Anchors(texts, window, shards)
        at = blocks.candidates(told)
        known = texts.ids.is_valid().to_numpy(zero_copy_only=False)
        doc = texts.ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.searchsorted(texts.first, at, "right") - 1
        start = at - texts.first[text]
        # Place in the chunk: texts of one id are one document.
        rank = np.unique(np.stack([known.astype(np.int64), doc], 1), axis=0, return_inverse=True)[1].ravel() if len(doc) else doc
        place = (rank[text] << 32) + start
        if len(place) and (np.diff(place) < 0).any():
            order = np.argsort(place, kind="stable")
            at, text, start, place = at[order], text[order], start[order], place[order]
        # A window is its two blocks; two hashes of them are told, of 64 and 32 bits.
        one, two = blocks.probe[at], blocks.probe[at + window // 2]
        one, two = words.chained(one, two), words.chained(two ^ _SECOND, one) >> np.uint64(32)
        order = np.argsort(one, kind="stable")
        if (two[order][1:] != two[order][:-1])[one[order][1:] == one[order][:-1]].any():
            order = np.lexsort((place, two, one))
        one, two, place = one[order], two[order], place[order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(new)
        self.at, self.of = at[order], np.cumsum(new) - 1
        # Of equal windows in the chunk those that start where the first does stay with it.
        self.later = place != place[first][self.of]
        self.one, self.two, text = one[first], two[first], text[order][first]
        self.start, self.known, self.doc = start[order][first], known[text], doc[text]
        self.spans = ranges(self.one, shards)

    def questions(self) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        for shard, a, b in self.spans:
            yield shard, ascending(self.one[a:b].astype("<u8")), planes(self.two[a:b].astype("<u4")), b"".join([
                planes(self.start[a:b].astype("<u4")), planes(self.known[a:b].astype("u1")), planes(self.doc[a:b].astype("<i8"))])

    def repeats(self, told: dict[int, bytes]) -> np.ndarray:
        """Starts of the windows that also start earlier."""
        earlier = np.zeros(len(self.one), bool)
        for shard, a, b in self.spans:
            earlier[a:b] = np.unpackbits(np.frombuffer(told[shard], np.uint8), count=b - a)
        return self.at[earlier[self.of] | self.later]


_QUESTION = "shard int, chunk long, first binary, second binary, third binary"


def _rows(chunk: int, questions: Iterator[tuple[int, bytes, bytes, bytes]]) -> pa.Table:
    shards, *told = zip(*listed) if (listed := list(questions)) else ((), (), (), ())
    return pa.table({
        "shard": pa.array(shards, pa.int32()), "chunk": pa.array([chunk] * len(shards), pa.int64()),
        **{name: pa.array(values, pa.binary()) for name, values in zip(("first", "second", "third"), told)}})


def _told(rows: pa.Table, stage: int) -> dict[int, bytes]:
    return {r["shard"]: r["told"] for r in rows.select(["stage", "shard", "told"]).to_pylist() if r["stage"] == stage}


def _one_chunk(chunks: pa.Table) -> tuple[int, Texts]:
    row = chunks.select(["chunk", "lengths", "content"]).slice(0, 1).to_pylist()[0]
    return row["chunk"], Texts.of(row, chunks["ids"].combine_chunks().flatten())


def _answers(rows: pa.Table, stage: int, told: list[np.ndarray]) -> pa.Table:
    return pa.table({
        "stage": pa.array([stage] * rows.num_rows, pa.int32()), "chunk": rows["chunk"], "shard": rows["shard"],
        "told": pa.array([np.packbits(x).tobytes() for x in told], pa.binary())})


def _find_hits(rows: pa.Table) -> pa.Table:
    """Blocks told to a shard -> for each anchor of each chunk whether it is anywhere else, as anchor or otherwise."""
    own = [reascending(x, "<u4") for x in rows["first"].to_pylist()]
    twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(o)).astype(bool) for x, o in zip(rows["second"].to_pylist(), own)]
    every = np.sort(np.concatenate([*own, *[reascending(x, "<u4") for x in rows["third"].to_pylist()]]))
    again = every[1:][every[1:] == every[:-1]]  # a chunk tells each once
    found = np.searchsorted(again, np.concatenate(own))
    hit = np.append(again, 0)[found] == np.concatenate(own) if len(again) else np.zeros(len(found), bool)
    hit &= found < len(again)
    return _answers(rows, 1, [h | t for h, t in zip(np.split(hit, np.cumsum([len(x) for x in own])[:-1]), twice)])


def _find_earlier(rows: pa.Table) -> pa.Table:
    """Windows told to a shard -> for each of each chunk whether another chunk has it at an earlier place."""
    one = [reascending(x, "<u8") for x in rows["first"].to_pylist()]
    counts = [len(x) for x in one]
    parts: list[list[np.ndarray]] = [[], [], []]
    for n, rest in zip(counts, rows["third"].to_pylist()):
        at = 0
        for kind, part in zip(("<u4", "u1", "<i8"), parts):
            size = n * np.dtype(kind).itemsize
            part.append(unplanes(rest[at:at + size], kind))
            at += size
    start, known, doc = map(np.concatenate, parts)
    one, two = np.concatenate(one), np.concatenate([unplanes(x, "<u4") for x in rows["second"].to_pylist()])
    order = np.lexsort((start, doc, known, two, one))
    one, two, start, known, doc = (x[order] for x in (one, two, start, known, doc))
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    earlier = np.zeros(len(one), bool)
    earlier[order] = (start != start[lead]) | (known != known[lead]) | (doc != doc[lead])
    return _answers(rows, 2, np.split(earlier, np.cumsum(counts)[:-1]))


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 20,
) -> DataFrame:
    """(id, n_words, n_removed, kept) of each row: its words, those removed, and the others joined by one space.

    Words stand between ASCII white space and are compared as they are. Removed is each word in a run of ``window`` words
    (an even number) that also starts earlier: in a row of smaller id, a null id being the least, or earlier in a row of the same
    id. So rows that repeat an id, null too, count as one document, and what starts at one place in several of them stays
    in all. Null and empty texts have no words; texts of less than ``window`` words stay as they are, but for their white space.
    Repeated rows come out each, an empty table gives no rows. Ids are integers. A text is held by one task whole. Columns
    other than the two named are not read.
    """
    if window % 2:
        raise ValueError("window must be even")
    rows = modest(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chunks = saved(rows.mapInArrow(
        _chunks, "chunk long, ids array<long>, lengths binary, content binary, words long"), "repeat-chunks")
    shards = max(1, -(-(chunks.agg(F.sum("words")).head()[0] or 0) // SHARD))
    texts = chunks.select("chunk", "ids", "lengths", "content")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                chunk, found = _one_chunk(pa.Table.from_batches([batch.slice(at, 1)]))
                yield from _rows(chunk, _Anchors(found, window, shards).questions()).combine_chunks().to_batches()

    hits = saved(
        texts.mapInArrow(probe, _QUESTION).groupBy("shard").applyInArrow(_find_hits, _ANSWER), "repeat-hits")

    def extend(chunks: pa.Table, told: pa.Table) -> pa.Table:
        if not chunks.num_rows:
            return _rows(0, iter(()))
        chunk, found = _one_chunk(chunks)
        return _rows(chunk, _Windows(found, window, shards, _told(told, 1)).questions())

    by_chunk = texts.groupBy("chunk")
    earlier = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(extend, _QUESTION) \
        .groupBy("shard").applyInArrow(_find_earlier, _ANSWER)

    def cut(chunks: pa.Table, told: pa.Table) -> pa.Table:
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": []}
        ids = pa.array([], pa.int64())
        if chunks.num_rows:
            _, found = _one_chunk(chunks)
            ids = found.ids
            at = _Windows(found, window, shards, _told(told, 1)).repeats(_told(told, 2))
            edge = np.zeros(len(found.starts) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
            gone = np.cumsum(edge)[:-1] > 0
            content = found.data.tobytes()
            for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
                stays = np.flatnonzero(~gone[a:b]) + a
                out["n_words"].append(b - a)
                out["n_removed"].append(b - a - len(stays))
                out["kept"].append(b" ".join([content[x:y] for x, y in zip(found.starts[stays].tolist(), found.ends[stays].tolist())]).decode())
        return pa.table({
            "id": ids, "n_words": pa.array(out["n_words"], pa.int64()), "n_removed": pa.array(out["n_removed"], pa.int64()),
            "kept": pa.array(out["kept"], pa.string())})

    return by_chunk.cogroup(hits.union(earlier).groupBy("chunk")).applyInArrow(
        cut, "id long, n_words long, n_removed long, kept string")
