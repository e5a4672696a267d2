"""Benchmark passages in documents, found in an FM-index of each shard of documents."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from feedloom.llm import words
from feedloom.llm.common import bytes_of, modest, saved, slices
from feedloom.llm.fm_index import FMIndex

#: Text of one shard, about; its index is built, searched and dropped.
SHARD_BYTES = 1 << 22
#: Text of a benchmark that is sent to all tasks together, about; a longer one goes through the documents part by part.
BENCHMARK_BYTES = 1 << 23


@dataclass(frozen=True)
class Phrases:
    """The windows to be found: their words as symbols from 1 on, by length, and the items that hold each."""

    vocabulary: np.ndarray
    windows: dict[int, np.ndarray]
    names: list[str]
    #: By length: where each window's items begin, and the items' places in ``names``.
    held: dict[int, tuple[np.ndarray, np.ndarray]]

    @property
    def shortest(self) -> int:
        return min(self.windows, default=0)

    def items(self, length: int, window: int) -> list[str]:
        begin, items = self.held[length]
        return [self.names[n] for n in items[begin[window]:begin[window + 1]].tolist()]


def _phrases(items: pa.Table, window: int) -> Phrases:
    """Windows of ``window`` words of each row (id, text); a text of fewer words, but not none, is one window."""
    data, offsets = bytes_of(items["text"].combine_chunks())
    starts, ends, first = words.spans(data, offsets, words.ALNUM)
    vocabulary, symbols = np.unique(words.hashes(data, starts, ends), return_inverse=True)
    names, item = np.unique(np.array(items["id"].to_pylist(), object).astype(str), return_inverse=True) if items.num_rows else ([], first[:0])
    size = np.diff(first)
    windows, held = {}, {}
    for length in sorted({*np.minimum(size, window).tolist()} - {0}):
        rows = np.flatnonzero(np.minimum(size, window) == length)
        count = size[rows] - length + 1
        at = np.repeat(first[rows] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        distinct, which = np.unique(symbols[at[:, None] + np.arange(length)] + 1, axis=0, return_inverse=True)
        pairs = np.unique(which.ravel() * len(names) + np.repeat(item[rows], count))
        windows[length] = distinct.astype("<i8")
        held[length] = np.searchsorted(pairs // len(names), np.arange(len(distinct) + 1)), pairs % len(names)
    return Phrases(vocabulary, windows, list(names), held)


def phrases(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> Iterator[Phrases]:
    """The windows of a benchmark, in parts of about ``BENCHMARK_BYTES`` of text; one part, if it has no more.

    Null ids are the empty id; items of one id are one item, which lies in one part.
    """
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    parts = max(1, -(-size // BENCHMARK_BYTES))
    for part in range(parts):
        yield _phrases(rows.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == part).toArrow(), window)


@dataclass
class Hits:
    """Of each text of a shard: its words, those within an occurrence, the items, and the merged runs of
    such words as places of words and as byte spans."""

    n_words: np.ndarray
    n_hit: np.ndarray
    items: dict[int, list[str]]
    runs: dict[int, list[tuple[int, int]]]
    spans: dict[int, list[tuple[int, int]]]


def scan(data: np.ndarray, offsets: np.ndarray, wanted: Phrases) -> Hits:
    """Index one shard and search it for all windows.

    The alphabet is that of the windows: any other word ends a run, as the end of a text does, and a run
    shorter than the shortest window holds none. Nothing else is left out.
    """
    starts, ends, first = words.spans(data, offsets, words.ALNUM)
    texts = len(offsets) - 1
    hits = Hits(np.diff(first), np.zeros(texts, np.int64), {}, {}, {})
    if not len(starts) or not wanted.windows:
        return hits
    hashed = words.hashes(data, starts, ends)
    place = np.minimum(np.searchsorted(wanted.vocabulary, hashed), len(wanted.vocabulary) - 1)
    known = wanted.vocabulary[place] == hashed
    begins, stops = known.copy(), known.copy()
    begins[1:] &= ~known[:-1]
    stops[:-1] &= ~known[1:]
    edge = first[(first > 0) & (first < len(starts))]
    begins[edge], stops[edge - 1] = known[edge], known[edge - 1]
    a, b = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    long = b - a >= wanted.shortest
    a, b = a[long], b[long]
    if not len(a):
        return hits
    # A separator, then the run; word_at tells the word at each place of the index.
    size = b - a + 1
    at = np.cumsum(size) - size
    word_at = np.repeat(a - at - 1, size) + np.arange(int(size.sum()))
    text = np.append(place[word_at] + 1, 0)
    text[at] = 0
    index = FMIndex(text)
    change = np.zeros(len(starts) + 1, np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for length, patterns in wanted.windows.items():
        which, position = index.search(patterns)
        word = word_at[position]
        np.add.at(change, word, 1)
        np.add.at(change, word + length, -1)
        of = np.searchsorted(first, word, "right") - 1
        for pair in np.unique(of * len(patterns) + which).tolist():
            items[pair // len(patterns)].update(wanted.items(length, pair % len(patterns)))
    hit = np.cumsum(change[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    hits.n_hit = total[first[1:]] - total[first[:-1]]
    hits.items = {text: sorted(of) for text, of in items.items()}
    for text in items:
        inside = np.concatenate([[False], hit[first[text]:first[text + 1]], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + first[text]
        hits.runs[text] = [(int(x - first[text]), int(y - first[text])) for x, y in zip(edges[::2], edges[1::2])]
        hits.spans[text] = [
            (int(starts[x] - offsets[text]), int(ends[y - 1] - offsets[text])) for x, y in zip(edges[::2], edges[1::2])]
    return hits


def _shards(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches put together or cut to shards, so that small batches share an index."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, column, SHARD_BYTES):
            held.append(part)
            size += len(bytes_of(part.column(column))[0])
            if size >= SHARD_BYTES:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                yield whole, *bytes_of(whole.column(column))
                held, size = [], 0
    if held:
        for whole in pa.Table.from_batches(held).combine_chunks().to_batches():
            yield whole, *bytes_of(whole.column(column))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 10,
) -> DataFrame:
    """(id, n_words, n_hit, items, spans) of each row of ``docs``.

    Words are letters, digits and whatever is beyond ASCII, A-Z like a-z; null text has none. A word is hit if it
    lies in an occurrence of a window of the benchmark. ``items`` are the ids of items with occurring windows,
    ``spans`` the merged stretches of hit words in code points, end exclusive. Repeated rows give repeated rows.
    """
    rows = modest(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = phrases(benchmark, window)
    first, second = next(parts), next(parts, None)
    if second is None:
        return _found_of(rows, first)
    return _found_in_parts(saved(rows.withColumn("number", F.monotonically_increasing_id()), "leak-texts"), chain((first, second), parts)).drop("number")


_FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _points(text: bytes, spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Byte spans in code points."""
    return [{"start": len(text[:a].decode()), "end": len(text[:b].decode())} for a, b in spans]


def _found_of(rows: DataFrame, part: Phrases) -> DataFrame:
    """Of all ``rows`` (id, text) what one part has found."""
    wanted = rows.sparkSession.sparkContext.broadcast(part)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _shards(batches, 1):
            hits = scan(data, offsets, wanted.value)
            spans = [
                _points(data[offsets[n]:offsets[n + 1]].tobytes(), hits.spans[n]) if n in hits.spans else [] for n in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(hits.n_words, pa.int64()), pa.array(hits.n_hit, pa.int64()),
                pa.array([hits.items.get(n, []) for n in range(batch.num_rows)], pa.list_(pa.string())), pa.array(spans, _SPANS),
            ], ["id", "n_words", "n_hit", "items", "spans"])

    return rows.mapInArrow(find, f"id {rows.schema['id'].dataType.simpleString()}, {_FOUND}")


def _found_in_parts(rows: DataFrame, parts: Iterable[Phrases]) -> DataFrame:
    """Of all ``rows`` (id, text, number; a written table) what all parts have found; the runs of all are put together in the end."""
    def of(part: Phrases) -> DataFrame:
        wanted = rows.sparkSession.sparkContext.broadcast(part)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, data, offsets in _shards(batches, 1):
                hits = scan(data, offsets, wanted.value)
                numbers = batch.column(0).take(pa.array([*hits.runs], pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    numbers, pa.array([[{"start": a, "end": b} for a, b in runs] for runs in hits.runs.values()], _SPANS),
                    pa.array([hits.items[n] for n in hits.runs], pa.list_(pa.string()))], ["number", "runs", "items"])

        found = saved(rows.select("number", "text").mapInArrow(
            find, "number long, runs array<struct<start:long,end:long>>, items array<string>"), "leak-parts")
        wanted.destroy()
        return found

    found = reduce(DataFrame.union, map(of, parts)).groupBy("number").agg(
        F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.flatten(F.collect_list("items"))).alias("items"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, SHARD_BYTES):
                data, offsets = bytes_of(part.column(2))
                starts, ends, first = words.spans(data, offsets, words.ALNUM)
                n_hit, spans = [], []
                for n, runs in enumerate(part.column(3).to_pylist()):
                    merged = _merged([(r["start"], r["end"]) for r in runs or ()])
                    n_hit.append(sum(b - a for a, b in merged))
                    at = [(int(starts[first[n] + a] - offsets[n]), int(ends[first[n] + b - 1] - offsets[n])) for a, b in merged]
                    spans.append(_points(data[offsets[n]:offsets[n + 1]].tobytes() if at else b"", at))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(np.diff(first), pa.int64()), pa.array(n_hit, pa.int64()),
                    pc.fill_null(part.column(4), pa.scalar([], part.column(4).type)), pa.array(spans, _SPANS),
                ], ["id", "number", "n_words", "n_hit", "items", "spans"])

    return rows.join(found, "number", "left").select("id", "number", "text", "runs", "items").mapInArrow(
        finish, f"id {rows.schema['id'].dataType.simpleString()}, number long, {_FOUND}")


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs that overlap or touch as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return b"".join(kept) + text[at:]


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", length_col: str | None = None, *, window: int = 10,
) -> DataFrame:
    """``docs`` without the words of benchmark passages; rows of which no word is left go.

    What is cut may bring new neighbours together, so what was cut is searched again until nothing is found.
    Rows without a passage stay as they are, also null and empty ones. ``length_col``, if named, is set to the
    new text's code points where text was cut. All other columns stay, repeated rows too; an empty table gives no rows.
    """
    parts = phrases(benchmark, window)
    first, second = next(parts), next(parts, None)
    if second is not None:
        return _without_parts(docs, lambda: phrases(benchmark, window), text_col, length_col)
    wanted = docs.sparkSession.sparkContext.broadcast(first)
    column = docs.columns.index(text_col)
    lengths = docs.columns.index(length_col) if length_col else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in _shards(batches, column):
            hits = scan(data, offsets, wanted.value)
            if not hits.spans:
                yield batch
                continue
            changed, gone = {}, set()
            todo = {n: (data[offsets[n]:offsets[n + 1]].tobytes(), spans) for n, spans in hits.spans.items()}
            while todo:
                changed.update((n, cut(text, spans)) for n, (text, spans) in todo.items())
                numbers = list(todo)
                again = bytes_of(pa.array([changed[n] for n in numbers], pa.binary()))
                found = scan(*again, wanted.value)
                gone.update(n for n, count in zip(numbers, found.n_words.tolist()) if not count)
                todo = {numbers[k]: (changed[numbers[k]], spans) for k, spans in found.spans.items()}
            texts = batch.column(column).to_pylist()
            for n, text in changed.items():
                texts[n] = text.decode()
            batch = batch.set_column(column, batch.schema.field(column), pa.array(texts, batch.schema.field(column).type))
            if lengths is not None:
                values = batch.column(lengths).to_pylist()
                for n in changed:
                    values[n] = len(texts[n])
                batch = batch.set_column(
                    lengths, batch.schema.field(lengths), pa.array(values, batch.schema.field(lengths).type))
            yield batch.filter(pa.array([n not in gone for n in range(batch.num_rows)]))

    return modest(docs).mapInArrow(clean, docs.schema)


def _without_parts(docs: DataFrame, parts: Callable[[], Iterator[Phrases]], text_col: str, length_col: str | None) -> DataFrame:
    """``without_leaks`` for a benchmark of several parts: all texts that were cut go through all parts again, until none is cut."""
    rows = modest(docs).select(F.struct("*").alias("row"), F.lit(False).alias("gone")).select(
        "row", F.col("row")[text_col].alias("text"), "gone", F.monotonically_increasing_id().alias("number"))
    rows = todo = saved(rows, "leak-rows")
    kept = []

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                cut_points(text, [(s["start"], s["end"]) for s in spans])
                for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), batch.column(3)], ["number", "text", "gone"])

    while True:
        found = _found_in_parts(todo.select(F.col("number").alias("id"), "text", "number"), parts()).where("n_hit > 0").select(
            "number", "spans", (F.col("n_words") == F.col("n_hit")).alias("gone"))
        todo = saved(todo.select("number", "text").join(found, "number").mapInArrow(
            trim, "number long, text string, gone boolean"), "leak-cut")
        if not todo.head(1):
            break
        kept.append(todo)
        todo = todo.where("NOT gone")
    # Of a row that was cut several times the last text counts.
    cut_rows = reduce(DataFrame.union, [df.withColumn("turn", F.lit(n)) for n, df in enumerate(kept)]) if kept else None
    if cut_rows is None:
        return rows.select("row.*")
    last = cut_rows.groupBy("number").agg(F.max(F.struct("turn", "text", "gone")).alias("last")).select("number", "last.text", "last.gone")
    joined = rows.select("row", "number").join(last, "number", "left").where("gone IS NULL OR NOT gone")
    new = {text_col: F.col("text")} | ({length_col: F.char_length("text")} if length_col else {})
    return joined.select(*[
        F.when(F.col("gone").isNotNull(), new[name].cast(docs.schema[name].dataType)).otherwise(F.col("row")[name]).alias(name)
        if name in new else F.col("row")[name].alias(name) for name in docs.columns])


def cut_points(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the spans, which are in code points."""
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at:start])
        at = end
    return "".join(kept) + text[at:]
