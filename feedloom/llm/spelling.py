"""Spelling variants: words of a corpus at one edit from each other, and the form each stands for.

Letters are hashed to a few symbols. Words at one edit have reduced words that are equal or at one edit. A word is
sent to the keys of its reduced word's neighbourhood, and whatever reduced words of the vocabulary are found there
is compared on the original strings. The neighbourhoods of the two words of a pair meet in both directions, so each
direction sends what the other does not: the reduced word itself, all with one symbol less, and all with
a greater symbol in one place. Insertions and lesser symbols are the other word's. A key is a polynomial hash,
which an edit changes in one step, so a word of any length has keys of eight bytes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedloom.llm.common import modest, saved, utf8

#: Symbols that letters are hashed to.
SYMBOLS = 6
#: Different words that a task counts before it sends them on.
_HELD = 1 << 17
#: Keys made together, about.
_KEYS = 1 << 18
#: Words of more letters are sent as a number with their keys, and fetched where they meet.
LONG = 64

# Runs of A-Z, a-z and U+00C0 to U+00FF in UTF-8; bytes.lower() changes A-Z alone.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")

_BASE = 0xD6E8FEB86659FD93
_UNDO = pow(_BASE, -1, 1 << 64)


def runs(doc_id: object, text: bytes, drop_every: int | None = None) -> Counter[bytes]:
    """The runs of letters of a text, A-Z as a-z.

    With ``drop_every`` a run loses the letter at ``h`` modulo its length where ``drop_every`` divides ``h``, the CRC-32
    of ``<doc_id>:<run>``; a null id counts as empty there.
    """
    counts = Counter(_RUN.findall(text.lower()))
    if drop_every and counts:
        found = list(counts)
        seed = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
        hashed = np.fromiter(map(zlib.crc32, found, repeat(seed)), np.int64, len(found))
        lost = [(found[i], counts.pop(found[i]), int(hashed[i])) for i in np.flatnonzero(hashed % drop_every == 0)]
        for run, n, h in lost:
            letters = run.decode()
            place = h % len(letters)
            counts[(letters[:place] + letters[place + 1:]).encode()] += n
    return counts


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_length: int = 5, least_count: int = 3,
    drop_every: int | None = None,
) -> DataFrame:
    """(word, n): the words of all texts, of ``least_length`` letters and ``least_count`` occurrences at least."""
    rows = modest(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for word, n in runs(doc_id, text, drop_every).items():
                    held[word] = held.get(word, 0) + n
                if len(held) > _HELD:
                    yield flush()
        if held:
            yield flush()

    return (
        rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
        .where((F.col("n") >= least_count) & (F.char_length("word") >= least_length)))


def _symbols(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbol of each letter of all words, n + 1 offsets)."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    # Multiplicative hashing spreads neighbouring code points.
    return ((points * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(symbols)).astype(np.int64), offsets


def _keys(words: list[str], symbols: int, base: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of a word, key, whether it is that of the reduced word itself) of what each word sends; with ``base`` only these."""
    symbol, offsets = _symbols(words, symbols)
    length = np.diff(offsets)
    value = np.random.default_rng(12).integers(1, 1 << 63, symbols, np.uint64) * np.uint64(2) + np.uint64(1)
    word = np.repeat(np.arange(len(words)), length)
    power = np.ones(int(length.max(initial=0)) + 1, np.uint64)
    power[1:] = _BASE
    power = np.cumprod(power, dtype=np.uint64)[np.arange(len(symbol)) - offsets[word]]
    part = value[symbol] * power
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
    whole = total[offsets[1:]] - total[offsets[:-1]]
    own = np.arange(len(words))
    if base:
        return own, whole, np.ones(len(words), bool)
    places, keys = [own], [whole]
    # Without one of several equal neighbours a word is the same, so only the last of them goes.
    last = np.ones(len(symbol), bool)
    last[:-1] = symbol[:-1] != symbol[1:]
    last[offsets[1:][length > 0] - 1] = True
    gone = np.flatnonzero(last)
    before = total[gone] - total[offsets[word[gone]]]
    after = total[offsets[word[gone] + 1]] - total[gone + 1]
    places.append(word[gone])
    keys.append(before + after * np.uint64(_UNDO))
    for step in range(1, symbols):
        at = np.flatnonzero(symbol + step < symbols)
        places.append(word[at])
        keys.append(whole[word[at]] + (value[symbol[at] + step] - value[symbol[at]]) * power[at])
    return np.concatenate(places), np.concatenate(keys), np.arange(sum(map(len, keys))) < len(words)


def _sent(symbols: int, base: bool):
    """Rows (word, sent, n) -> a row for each of the word's keys, with what is sent."""
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            size = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
            start = 0
            while start < len(words):
                end = max(start + 1, int(np.searchsorted(size, size[start] + (_KEYS if base else 2 * _KEYS // symbols), "right")) - 1)
                place, key, own = _keys(words[start:end], symbols, base)
                part = batch.slice(start, end - start).select(["sent", "n"])
                for at in range(0, len(place), _KEYS):
                    rows = part.take(pa.array(place[at:at + _KEYS]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[at:at + _KEYS].view(np.int64)), rows.column(0), rows.column(1), pa.array(own[at:at + _KEYS]),
                    ], ["key", "sent", "n", "own"])
                start = end
    return send


def _meeting(words: DataFrame, symbols: int) -> DataFrame:
    """(own, sent, n, kept, kept_n): what ``words`` (word, sent, n) send, beside the words that have its keys."""
    kind = f"key long, sent {words.schema['sent'].dataType.simpleString()}, n long, own boolean"
    sent = words.mapInArrow(_sent(symbols, False), kind)
    kept = words.mapInArrow(_sent(symbols, True), kind).select(
        "key", F.col("sent").alias("kept"), F.col("n").alias("kept_n"))
    return sent.join(kept, "key").drop("key")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n) of all words of ``words`` (word, n) at exactly one edit; each pair once."""
    size, number = F.char_length("word"), F.xxhash64("word")
    short = _meeting(words.where(size <= LONG).select("word", F.col("word").alias("sent"), "n"), symbols).select(
        "own", F.col("sent").alias("word"), "n", F.col("kept").alias("near"), F.col("kept_n").alias("near_n"))
    # Words of LONG letters are in both; a pair with a longer word is told here alone.
    long = words.where(size >= LONG)
    met = _meeting(long.select("word", number.alias("sent"), "n"), symbols).where("sent <> kept")
    far = (
        met.join(long.select(number.alias("sent"), "word"), "sent")
        .join(long.select(number.alias("kept"), F.col("word").alias("near")), "kept")
        .where((F.char_length("word") > LONG) | (F.char_length("near") > LONG))
        .select("own", "word", "n", "near", F.col("kept_n").alias("near_n")))
    return short.unionByName(far).where(
        (~F.col("own") | (F.col("word") < F.col("near"))) & (F.levenshtein("word", "near", 1) == 1)
    ).drop("own")


def variants(words: DataFrame, symbols: int = SYMBOLS, *, least_ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n), whose words are distinct.

    ``form`` is the near word of largest n, of equal ones the least, if it has ``least_ratio`` times the word's n; else
    null, and so is ``form_n``. ``root`` is the last of the forms that follow each other from the word on, the word itself
    without one. A null word is near nothing.
    """
    words = words.where("word IS NOT NULL")
    pairs = near_pairs(words, symbols)
    both = pairs.select(F.inline(F.array(
        F.struct("word", F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word")).alias("beside")),
        F.struct(F.col("near").alias("word"), F.struct((-F.col("n")).alias("less"), F.col("word")).alias("beside")))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("beside").alias("best"))
    held = -F.col("best.less") >= least_ratio * F.col("n")
    rows = saved(words.select("word", "n").join(best, "word", "left").select(
        "word", F.when(held, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, -F.col("best.less")).alias("form_n")), "spelling-forms")
    # Roots go from forms to the words that have them. The count at least doubles with each step, so the rounds are few;
    # a word is the form of its neighbours at most.
    names = ["word", "form", "root", "n", "n_near", "form_n"]
    below = rows.where("form IS NOT NULL")
    last = found = rows.where("form IS NULL").withColumn("root", F.col("word")).select(*names)
    while last.head(1):
        roots = last.select(F.col("word").alias("form"), "root")
        last = saved(below.join(roots, "form").select(*names), "spelling-roots")
        found = found.union(last)
    return found


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_length: int = 5, least_count: int = 3,
    drop_every: int | None = None, symbols: int = SYMBOLS,
) -> DataFrame:
    """``variants`` of the ``vocabulary`` of ``docs``.

    Null texts have no words; repeated rows count each; a null id counts as an empty one. Without words, as of an empty
    table, no rows come out. Columns other than the two named are not read.
    """
    words = saved(vocabulary(
        docs, id_col, text_col, least_length=least_length, least_count=least_count, drop_every=drop_every), "spelling-words")
    return variants(words, symbols)
