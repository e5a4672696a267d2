"""Scores of texts by a weighted backoff automaton over smoothed n-grams of words.

A state is an n-gram seen in training, the state of no words is the root. An arc adds a word; where a state has
no arc for it, the failure arc leads to the state without its first word. With c the
counts and p the probability after the failure arc, an arc of state s weighs (c(s w) + m p) / (c(s) + m), its
failure arc m / (c(s) + m), and the root (c(w) + 1) / (N + V + 1): smoothing with a Dirichlet prior of strength m.

The automaton grows with the corpus, so no task holds it. Texts lie in blocks; a block asks for the counts of
its distinct n-grams, which are summed where an n-gram is dealt to. An n-gram can be in another block only if the two
that it begins and ends with are, so the orders are asked one after another, and of each only such n-grams; the
others' counts are the block's own. Each block then has just the arcs it needs and finds the weights of all its
tokens at once, order by order, which equals the walk from state to state.

Words are told apart by 64-bit hashes. Longer n-grams are asked for by 40 bits within a shard of a bounded number of
n-grams: one in some 500,000 may get another's count besides its own, at any size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm import words
from feedloom.llm.coding import ascending, planes, ranges, reascending, unplanes, within
from feedloom.llm.common import bucketed, bytes_of, modest, saved, slices

#: Bytes of text in a block.
BLOCK = 1 << 22
#: Tokens of the corpus for each shard of an order's n-grams, about.
SHARD = 1 << 21

_END = np.uint64(0x5EED0FE4D0F7E875)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token of all texts, each text's end last; tokens of each text)."""
    starts, ends, first = words.spans(data, offsets, words.SPACED)
    counts = np.diff(first) + 1
    out = np.full(int(counts.sum()), _END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[np.cumsum(counts) - 1] = False
    out[inner] = words.hashes(data, starts, ends)
    return out, counts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, train, text) -> a row for each block: its texts' ids, whether they train, their words."""
    number, held, size = TaskContext.get().partitionId() << 32, [], 0

    def block() -> pa.RecordBatch:
        nonlocal number
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        tokens, counts = _tokens(*bytes_of(rows.column(2)))
        train = rows.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
        vocabulary, place = np.unique(tokens, return_inverse=True)
        ids = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column(0))
        out = pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), ids, pa.array([train.tobytes()]), pa.array([counts.astype("<u4").tobytes()]),
            pa.array([ascending(vocabulary)]), pa.array([zstandard.compress(planes(place.astype("<u4")), 1)]),
            pa.array([len(tokens)], pa.int64()), pa.array([int(counts[train > 0].sum())], pa.int64()),
        ], ["block", "ids", "train", "counts", "vocabulary", "places", "tokens", "train_tokens"])
        number += 1
        return out

    for batch in batches:
        for part in slices(batch, 2, BLOCK):
            weight = len(bytes_of(part.column(2))[0])
            if held and size + weight > BLOCK:
                yield block()
                held, size = [], 0
            held.append(part)
            size += weight
    if held:
        yield block()


def _ngrams(tokens: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``order`` words: (hash of the n-gram that ends at each token, whether there is one).

    The first token of a text follows the end of another one; an n-gram may begin with an end, or end with it.
    """
    line = np.concatenate([[_END], tokens])
    found, inside = line, np.ones(len(tokens), bool)
    yield tokens, inside
    for n in range(2, order + 1):
        found = words.chained(found[:-1], line[n - 1:])
        if n > 2:
            # The token n - 2 before must be within the text, and no end.
            inside = inside.copy()
            inside[:n - 2] = False
            inside[n - 2:] &= tokens[:max(0, len(tokens) - n + 2)] != _END
        out = np.zeros(len(tokens), np.uint64)
        out[n - 2:] = found
        yield out, inside


def _short(values: np.ndarray, n: int, shard: int, shards: int) -> np.ndarray:
    """What a shard is told of its ascending hashes: of words the hash itself, of longer n-grams 40 bits of it."""
    return values if n == 1 else within(values, shard, shards, 40)


class _Counts:
    """The n-grams of a block, order by order, with their counts in the block and, where told, in the corpus."""

    def __init__(self, row: dict, shards: int, told: pa.Table | None = None):
        vocabulary = reascending(row["vocabulary"], "<u8")
        places = unplanes(zstandard.decompress(row["places"]), "<u4")
        self.tokens, self.shards, self.block = vocabulary[places], shards, row["block"]
        self._trains = np.repeat(np.frombuffer(row["train"], np.uint8), np.frombuffer(row["counts"], "<u4"))
        self._told: dict[int, dict[int, tuple[bytes, bytes]]] = {}
        for answer in told.select(["n", "shard", "told", "alone"]).to_pylist() if told else []:
            self._told.setdefault(answer["n"], {})[answer["shard"]] = answer["told"], answer["alone"]
        self.exists: list[np.ndarray] = []
        #: Of the n-gram that ends at each token: the corpus count, and whether other blocks may have it.
        self.counts: list[np.ndarray] = []
        self._shared: list[np.ndarray] = []
        self._ngrams = _ngrams(self.tokens, 1 << 30)
        self._first = vocabulary, places

    def next_order(self) -> tuple[int, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """(n, hashes to ask for, their counts here, spans of shards) of the next order; what was told of it is taken in."""
        n = len(self.counts) + 1
        hashed, exists = next(self._ngrams)
        if n == 1:
            distinct, place = self._first
            open_ = np.ones(len(distinct), bool)
        else:
            distinct, place = np.unique(hashed[exists], return_inverse=True)
            ends = self._shared[-1]
            begins = np.concatenate([ends[:1], ends[:-1]]) if n > 2 else np.concatenate([[True], ends[:-1]])
            open_ = np.zeros(len(distinct), bool)
            open_[place[(ends & begins)[exists]]] = True
        here = np.bincount(place, self._trains[exists], len(distinct)).astype(np.int64)
        asked = np.flatnonzero(open_)
        spans = ranges(distinct[asked], self.shards)
        total, shared = here.copy(), np.zeros(len(distinct), bool)
        for shard, a, b in spans if n in self._told else ():
            told, alone = self._told[n][shard]
            others = ~np.unpackbits(np.frombuffer(alone, np.uint8), count=b - a).astype(bool)
            total[asked[a:b][others]] = unplanes(told, "<i8")
            shared[asked[a:b]] = others
        of, may = np.zeros(len(self.tokens), np.int64), np.zeros(len(self.tokens), bool)
        of[exists], may[exists] = total[place], shared[place]
        self.counts.append(of)
        self._shared.append(may)
        self.exists.append(exists)
        return n, distinct[asked], here[asked], spans

    def questions(self, order: int) -> pa.Table:
        """What the block asks of each shard about its n-grams of ``order`` words."""
        for _ in range(order - 1):
            self.next_order()
        n, hashes, here, spans = self.next_order()
        return pa.table({
            "shard": pa.array([s for s, _, _ in spans], pa.int32()), "n": pa.array([n] * len(spans), pa.int32()),
            "block": pa.array([self.block] * len(spans), pa.int64()),
            "hashes": pa.array([ascending(_short(hashes[a:b], n, s, self.shards)) for s, a, b in spans], pa.binary()),
            "seen": pa.array([planes(here[a:b].astype("<u4")) for _, a, b in spans], pa.binary()),
        })


_ASKED = "shard int, n int, block long, hashes binary, seen binary"
_TOLD = "shard int, n int, block long, told binary, alone binary, known long"
_OF_BLOCK = ["block", "train", "counts", "vocabulary", "places"]


def _answer(rows: pa.Table) -> pa.Table:
    """All that is asked of one shard about one order -> for each block which n-grams no other has, and of the others the corpus
    counts; the n-grams seen in training."""
    asked = [reascending(x, "<u8") for x in rows["hashes"].to_pylist()]
    seen = np.concatenate([unplanes(x, "<u4") for x in rows["seen"].to_pylist()])
    distinct, place, blocks = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
    total = np.bincount(place, seen, len(distinct)).astype("<i8")
    told, alone = [], []
    for part in np.split(place, np.cumsum([len(x) for x in asked])[:-1]):
        only = blocks[part] == 1  # a block asks for each once
        told.append(planes(total[part[~only]]))
        alone.append(np.packbits(only).tobytes())
    known = [0] * len(asked)
    known[0] = int((total > 0).sum())
    return pa.table({
        "shard": rows["shard"], "n": rows["n"], "block": rows["block"],
        "told": pa.array(told, pa.binary()), "alone": pa.array(alone, pa.binary()), "known": pa.array(known, pa.int64()),
    })


def traverse(counts: list[np.ndarray], exists: list[np.ndarray], start: int, n: int, v: int, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """(root weight, weight of the arcs taken) at each token, as probabilities.

    ``counts[k]`` is the count of the n-gram of k + 1 words that ends at each token. The state before a token is the
    longest n-gram that ends at the one before and was seen; weights are those of the failure arcs from there down to a
    state with an arc, and of that arc.
    """
    root = (counts[0] + 1) / (n + v + 1)
    weight = root
    for k in range(1, len(counts)):
        # Of the first token the state is the end of a text.
        state = np.concatenate([[start if k == 1 else 0], counts[k - 1][:-1]])
        taken = (counts[k] + strength * weight) / (state + strength)
        weight = np.where(exists[k] & (state > 0), taken, weight)
    return root, weight


def _score(order: int, shards: int, n: int, v: int, start: int, strength: float, id_type: pa.DataType):
    names = ["id", "train", "n_tokens", "n_known", "base_score", "score"]
    kinds = [id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def score(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        if not blocks.num_rows:
            return pa.table([pa.array([], kind) for kind in kinds], names)
        row = blocks.select(_OF_BLOCK).to_pylist()[0]
        ngrams = _Counts(row, shards, answers)
        for _ in range(order):
            ngrams.next_order()
        counts, exists = ngrams.counts, ngrams.exists
        root, weight = traverse(counts, exists, start, n, v, strength)
        size = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        first = np.cumsum(size) - size
        return pa.table([
            blocks["ids"].combine_chunks().flatten(), np.frombuffer(row["train"], np.uint8) > 0, size,
            np.add.reduceat((counts[0] > 0).astype(np.int64), first),
            np.add.reduceat(np.log10(root), first), np.add.reduceat(np.log10(weight), first),
        ], names)
    return score


def score_texts(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", *, order: int = 2, strength: float = 300.0,
) -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``; scores are log10.

    Learns from the rows for which ``train`` is true (null: no). Words stand between ASCII white space, A-Z count as
    a-z, and each text has an end as its last token; null text counts as empty. ``base_score`` is that of the root
    alone, add-one smoothed. Without training rows every token weighs the same. Repeated rows count and come out each.
    """
    rows = modest(docs).select(
        F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = bucketed(rows.mapInArrow(
        _blocks, f"block long, ids array<{kind}>, train binary, counts binary, vocabulary binary, places binary, "
        "tokens long, train_tokens long"), "lm-blocks", "block")
    tokens, n = blocks.agg(F.sum("tokens"), F.sum("train_tokens")).head()
    tokens, n = tokens or 0, n or 0
    start = rows.where("train").count()
    shards = max(1, -(-tokens // SHARD))
    by_block = blocks.select("ids", *_OF_BLOCK).groupBy("block")

    def ask_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                yield from _Counts(row, shards).questions(1).combine_chunks().to_batches()

    def ask(size: int):
        def of(blocks: pa.Table, answers: pa.Table) -> pa.Table:
            rows = blocks.select(_OF_BLOCK).to_pylist() or [
                {"block": 0, "train": b"", "counts": b"", "vocabulary": b"", "places": zstandard.compress(b"")}]
            return _Counts(rows[0], shards, answers).questions(size)
        return of

    def answered(asked: DataFrame) -> DataFrame:
        return asked.groupBy("shard", "n").applyInArrow(_answer, _TOLD)

    answers = saved(answered(blocks.select(*_OF_BLOCK).mapInArrow(ask_first, _ASKED)), "lm-counts")
    v = answers.agg(F.sum("known")).head()[0] or 0
    for size in range(2, order + 1):
        asked = by_block.cogroup(answers.groupBy("block")).applyInArrow(ask(size), _ASKED)
        answers = answers.union(saved(answered(asked), "lm-counts"))
    from pyspark.sql.pandas.types import to_arrow_type

    score = _score(order, shards, n, v, start, strength, to_arrow_type(rows.schema["id"].dataType))
    found = by_block.cogroup(answers.groupBy("block")) \
        .applyInArrow(score, f"id {kind}, train boolean, n_tokens long, n_known long, base_score double, score double")
    return found.withColumn("train_tokens", F.lit(n).cast("long"))
