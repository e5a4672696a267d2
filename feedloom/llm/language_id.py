"""Language of a text: sparse multinomial logistic regression on TF-IDF of character n-grams.

Trained with follow-the-regularised-leader (proximal, elastic net) on a bounded
sample of labelled rows, then calibrated by one temperature on rows held back
from that sample. Document frequencies are counted over all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm.common import modest, slices, strings

#: n-grams of 1 to 3 characters, hashed to this many features.
FEATURES = 1 << 14
ORDERS = 3
#: Rows of each language to train on, about, and of all languages together; the whole text of each is used.
SAMPLE = 1000
SAMPLE_OF_ALL = 20_000
UNKNOWN = "und"

_ASCII = np.arange(128, dtype=np.uint32)
_ASCII[[c for c in range(128) if not chr(c).isalpha()]] = 32
#: Multipliers of the characters of an n-gram (odd random numbers).
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_SHIFT = np.uint32(32 - FEATURES.bit_length() + 1)


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(features of the n-grams that begin at each character, one array an order; first place and end of each text).

    Characters are lower-cased, what is ASCII but no letter counts as a space; each text ends with spaces, so that
    no n-gram reaches into the next.
    """
    codes = np.frombuffer("".join(t + "   " for t in map(str.lower, texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    small = codes < 128
    codes = np.where(small, _ASCII[np.where(small, codes, 0)], codes)
    ends = np.cumsum([len(t.lower()) + 3 for t in texts]) if texts else np.zeros(0, np.int64)
    firsts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if texts else ends
    found, value = [], np.zeros(len(codes), np.uint32)
    for order in range(ORDERS):
        shifted = np.zeros(len(codes), np.uint32)
        shifted[:len(codes) - order] = codes[order:]
        value = value + (shifted + np.uint32(order + 1)) * _FACTORS[order]
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        found.append(((mixed ^ (mixed >> np.uint32(12))) * np.uint32(0x297A2D39)) >> _SHIFT)
    return found, firsts, ends


def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts -> (feature, documents that hold it), once for the partition; feature -1 counts the documents."""
    holds, total = np.zeros(FEATURES + 1, np.int64), 0
    seen = np.zeros(FEATURES, bool)
    for batch in batches:
        for part in slices(batch, 0, 1 << 21):
            found, firsts, ends = grams(strings(part.column(0)))
            for a, b in zip(firsts.tolist(), ends.tolist()):
                for features in found:
                    seen[features[a:b]] = True
                holds[:-1] += seen
                seen[:] = False
            total += part.num_rows
    holds[-1] = total
    features = np.arange(FEATURES + 1)
    features[-1] = -1
    some = holds > 0
    yield pa.RecordBatch.from_arrays([pa.array(features[some], pa.int32()), pa.array(holds[some])], ["feature", "documents"])


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, salt, text) -> (label, salt, features, their share of all n-grams)."""
    for batch in batches:
        for part in slices(batch, 2, 1 << 21):
            found, firsts, ends = grams(strings(part.column(2)))
            features, shares = [], []
            for a, b in zip(firsts.tolist(), ends.tolist()):
                counts = np.bincount(np.concatenate([f[a:b] for f in found]), minlength=FEATURES)
                some = np.flatnonzero(counts)
                features.append(some.astype("<u2").tobytes())
                shares.append((counts[some] / counts.sum()).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(features), pa.array(shares)], ["label", "salt", "features", "shares"])


class Ftrl:
    """Follow the regularised leader, proximal: per-coordinate rates, L1 and L2 penalties, softmax loss."""

    def __init__(self, labels: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self._z, self._n = np.zeros((FEATURES, labels)), np.zeros((FEATURES, labels))
        self._alpha, self._beta, self._l1, self._l2 = alpha, beta, l1, l2

    def weights(self, features=slice(None)) -> np.ndarray:
        z, n = self._z[features], self._n[features]
        lead = np.sign(z) * np.maximum(np.abs(z) - self._l1, 0)
        return -lead / ((self._beta + np.sqrt(n)) / self._alpha + self._l2)

    def learn(self, features: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(features)
        error = softmax(values @ weights)
        error[label] -= 1
        gradient = values[:, None] * error
        n = self._n[features]
        after = n + gradient * gradient
        self._z[features] += gradient - (np.sqrt(after) - np.sqrt(n)) / self._alpha * weights
        self._n[features] = after


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(-1, keepdims=True))
    return raised / raised.sum(-1, keepdims=True)


@dataclass(frozen=True)
class Model:
    labels: list[str]
    #: float32, a row for each label: weight times inverse document frequency.
    weights: np.ndarray
    temperature: float

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Label and its calibrated probability; ``und`` and 0 for a text without letters."""
        if not self.labels:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        found, firsts, ends = grams(texts)
        logits = np.array([
            sum(np.add.reduceat(weights[features], firsts, dtype=np.float64) for features in found) for weights in self.weights
        ]).T / (ORDERS * (ends - firsts))[:, None]
        odds = softmax(logits / self.temperature)
        best = odds.argmax(1)
        said = [any(map(str.isalpha, text)) for text in texts]
        return (
            [self.labels[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), said)],
            [float(row[b]) if ok else 0.0 for row, b, ok in zip(odds, best.tolist(), said)],
        )


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which the labels are likeliest.

    One row more is taken to be mislabelled, or rows told apart without error would make every score 1.
    """
    count, kinds = logits.shape
    if not count or kinds < 2:
        return 1.0
    aim = np.full((count, kinds), 1 / (count + 2) / (kinds - 1))
    aim[np.arange(count), labels] = 1 - 1 / (count + 2)
    candidates = np.geomspace(0.05, 20, 121)
    loss = [-(aim * np.log(softmax(logits / t) + 1e-300)).sum() for t in candidates]
    return float(candidates[int(np.argmin(loss))])


#: Values are shares of n-grams, far below one; this brings them to the size the learner's rates are made for.
_SCALE = 100.0


def train(rows: DataFrame, label_col: str = "lang", text_col: str = "text", *, sample: int = SAMPLE, passes: int = 3) -> Model:
    """Learn from the rows whose label and text are not null.

    Document frequencies come from all of them, weights from about ``sample`` different texts of each label, chosen by
    their hash, fewer where there are so many labels that these were more than ``SAMPLE_OF_ALL``, but ten each at least; a
    fifth of these sets the temperature. No rows, as of an empty table: a model that knows no label. Repeated rows count
    in the frequencies and once in the sample. Columns other than the two named are not read.
    """
    known = modest(rows).select(F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text")).dropna()
    salted = known.withColumn("salt", F.xxhash64("text", F.lit("language sample")))
    # Copies of a text have one salt; a large group of them counts as one text.
    counts = {r.label: r["count"] for r in salted.select("label", "salt").distinct().groupBy("label").count().collect()}
    sample = min(sample, max(10, SAMPLE_OF_ALL // max(1, len(counts))))
    labels = sorted(counts)
    if not labels:
        return Model([], np.zeros((0, FEATURES), np.float32), 1.0)
    documents = np.zeros(FEATURES + 1)
    for row in known.select("text").mapInArrow(_count_documents, "feature int, documents long") \
            .groupBy("feature").agg(F.sum("documents").alias("documents")).collect():
        documents[row.feature] = row.documents
    idf = np.log((1 + documents[-1]) / (1 + documents[:-1])) + 0.1
    shares = F.broadcast(rows.sparkSession.createDataFrame(
        [(label, float(min(1.0, sample / counts[label]) * (1 << 40))) for label in labels], "label string, share double"))
    chosen = salted.join(shares, "label").where(F.pmod("salt", F.lit(1 << 40)) < F.col("share")) \
        .groupBy("label", "salt").agg(F.first("text").alias("text")).mapInArrow(_featurise, "label string, salt long, features binary, shares binary")
    examples, number = [], {label: n for n, label in enumerate(labels)}
    for row in chosen.collect():
        features = np.frombuffer(row.features, "<u2").astype(np.int64)
        values = np.frombuffer(row.shares, "<f4") * idf[features] * _SCALE
        examples.append((row.salt, number[row.label], features, values))
    examples.sort(key=lambda e: (e[0], e[1]))
    held = [e for n, e in enumerate(examples) if n % 5 == 4]
    learner = Ftrl(len(labels))
    for _ in range(passes):
        for n, (_, label, features, values) in enumerate(examples):
            if n % 5 != 4 or len(examples) < 50:
                learner.learn(features, values, label)
    weights = learner.weights()
    logits = np.array([values @ weights[features] for _, _, features, values in held]).reshape(len(held), len(labels))
    return Model(
        labels, np.ascontiguousarray((weights * idf[:, None] * _SCALE).T, np.float32),
        _temperature(logits, np.array([e[1] for e in held], np.int64)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, score) of each row; the text alone is looked at, whole.

    ``und`` with score 0 if the text is null, has no letter, or the model knows no label. Repeated rows come out each, an
    empty table gives no rows, and columns other than the two named are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = modest(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, 1 << 20):
                label, score = sent.value.predict(strings(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(label), pa.array(score)], ["id", "label", "score"])

    return rows.mapInArrow(read, f"id {rows.schema['id'].dataType.simpleString()}, label string, score double")


def identified(docs: DataFrame, model: Model, text_col: str = "text", *, min_score: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language the model tells with probability ``min_score`` or more, all columns as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    column = docs.columns.index(text_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, 1 << 20):
                label, score = sent.value.predict(strings(part.column(column)))
                yield part.filter(pa.array([la != UNKNOWN and s >= min_score for la, s in zip(label, score)]))

    return modest(docs).mapInArrow(read, docs.schema)


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether the id's CRC-32 falls in ``part``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == part, F.lit(False))
