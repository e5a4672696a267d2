"""Secrets in texts, and whose they are: how many owners and repositories hold each value in the whole corpus.

Fixed patterns give the base findings. Besides these, whatever looks like a
credential (long, of mixed characters, of high entropy) is a candidate; its hash
is counted over the corpus, and it is a finding of its own only if it belongs to
few owners. What many owners hold was copied from an example.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from math import log2

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from feedloom.llm.common import modest, saved, slices, spread_join, strings

#: In the order of the listing of spans that begin together.
KINDS = ("assign", "access", "hex", "owned")
OWNED = 3

# The patterns of the base findings. The length a value must have is part of the last two, which
# leaves the same matches, since what they match is all of a stretch of their characters.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LEAST_ASSIGNED = 6

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_SPANS = "array<struct<start:long,end:long,kind:int,value:long>>"


def live_looking(value: str) -> bool:
    """20 characters or more with digits and letters, of at least 3 bits each; not one run of a few characters."""
    if len(value) < 20 or not re.search(r"[0-9]", value) or not re.search(r"[A-Za-z]", value):
        return False
    shares = [value.count(c) / len(value) for c in set(value)]
    return -sum(s * log2(s) for s in shares) >= 3.0


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, kind, hash of the value) of the base findings and of other candidates that these do not cover."""
    found = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        found += [(m.start(), m.end(), 0, m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST_ASSIGNED]
    found += [(m.start(), m.end(), 1, m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2, m[0]) for m in _HEX.finditer(text)]
    # Stretches that the base findings cover: these may touch or overlap.
    starts, ends = [], []
    for a, b in sorted((a, b) for a, b, _, _ in found):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for m in _CANDIDATE.finditer(text):
        if live_looking(m[0]):
            at = bisect_right(starts, m.start()) - 1
            if at < 0 or ends[at] < m.end():
                found.append((m.start(), m.end(), OWNED, m[0]))
    found.sort(key=lambda f: (f[0], f[2]))
    return [(a, b, kind, xxhash.xxh64_intdigest(value.lower().encode()) - (1 << 63)) for a, b, kind, value in found]


def _spans_of(texts: list[str]) -> pa.Array:
    return pa.array(
        [[{"start": a, "end": b, "kind": k, "value": v} for a, b, k, v in candidates(t)] for t in texts],
        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.int64())])))


def _ownership(values: DataFrame) -> DataFrame:
    """(value, owners, repositories, n) of rows (value, owner, repository), ``n`` of each value; each step sums up before
    it deals out. A written table."""
    by_repository = values.groupBy("value", "owner", "repository").agg(F.count("*").alias("n"))
    by_owner = by_repository.groupBy("value", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return saved(by_owner.groupBy("value").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("n")), "secret-values")


def _owned(max_owners: int, max_repositories: int) -> Column:
    """One owner may have its key in any number of repositories; what several have is theirs only while it is rare."""
    return (F.col("owners") == 1) | ((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories))


def _scanned(rows: DataFrame) -> DataFrame:
    """Rows (row, owner, repository, text) with their spans and a number, without the text, as a written table."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3, 1 << 24):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), _spans_of(strings(part.column(3)))],
                    ["row", "owner", "repository", "spans"])

    kind = rows.schema["row"].dataType.simpleString()
    scanned = rows.mapInArrow(scan, f"row {kind}, owner string, repository string, spans {_SPANS}")
    return saved(scanned.withColumn("number", F.monotonically_increasing_id()), "secrets")


def _name(column: str):
    """Owner or repository as text; null is one of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str = "doc_id", *, max_owners: int = 2, max_repositories: int = 20,
) -> DataFrame:
    """(id, spans) of each row: spans are (start, kind, end, owners, repositories, owned) in order, in code points.

    ``kind`` counts in KINDS. Base findings always stay; ``owned`` tells those whose value one owner holds, or
    at most ``max_owners`` in ``max_repositories`` repositories together, from copies of an example, and a candidate without a base
    pattern is a finding only if it is owned.
    Values are compared without case. Null owners are one owner, null text has no spans, repeated rows count once.
    """
    found = _scanned(modest(docs).select(
        F.struct(F.col(id_col).alias("id")).alias("row"), _name(owner_col).alias("owner"),
        _name(repository_col).alias("repository"), F.col(text_col).alias("text")))
    single = found.select("number", "owner", "repository", F.explode("spans").alias("span")).select(
        "number", "owner", "repository", "span.*")
    # A copied example may be any share of the spans.
    judged = spread_join(single, _ownership(single.select("value", "owner", "repository")), ["value"]) \
        .withColumn("owned", _owned(max_owners, max_repositories)).where((F.col("kind") != OWNED) | F.col("owned"))
    lists = judged.groupBy("number").agg(F.array_sort(F.collect_list(
        F.struct("start", "kind", "end", "owners", "repositories", "owned"))).alias("spans"))
    return found.select("row.id", "number").join(lists, "number", "left").select(
        "id", F.coalesce("spans", F.array().cast(lists.schema["spans"].dataType)).alias("spans"))


def mask(text: str, spans: list[tuple[int, int]], put: str) -> str:
    """``text`` with each stretch of spans that touch or overlap replaced by ``put``."""
    kept, at, reach = [], 0, -1
    for start, end in sorted(spans):
        if start > reach:
            kept += [text[at:start], put]
        reach = max(reach, end)
        at = reach
    return "".join(kept) + text[at:] if spans else text


def without_secrets(
    docs: DataFrame, text_col: str = "text", owner_col: str = "source", repository_col: str = "doc_id",
    length_col: str | None = None, *, max_owners: int = 2, max_repositories: int = 20, put: str = "[SECRET]",
) -> DataFrame:
    """``docs`` with every finding of ``find_secrets`` replaced by ``put``; no row goes.

    ``length_col``, if named, is set to the new text's code points where text was replaced. All other columns and
    all rows without findings stay as they are. Texts are shuffled only where a candidate has to be judged.
    """
    found = _scanned(modest(docs).select(
        F.struct("*").alias("row"), _name(owner_col).alias("owner"), _name(repository_col).alias("repository"),
        F.col(text_col).alias("text")))
    single = found.select("number", "owner", "repository", F.explode("spans").alias("span")).select(
        "number", "owner", "repository", "span.value", "span.kind")
    owned = _ownership(single.select("value", "owner", "repository")).where(_owned(max_owners, max_repositories))
    live = spread_join(single.where(F.col("kind") == OWNED).select("number", "value").distinct(), owned, ["value"]) \
        .groupBy("number").agg(F.collect_list("value").alias("live"))
    judge = F.exists("spans", lambda span: span["kind"] == OWNED)
    sure = found.where(~judge).select("row", "spans", F.array().cast("array<long>").alias("live"))
    rest = found.where(judge).join(live, "number", "left").select(
        "row", "spans", F.coalesce("live", F.array().cast("array<long>")).alias("live"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.RecordBatch.from_struct_array(batch.column(0))
            spans = batch.column(1).to_pylist()
            changed = [n for n, of in enumerate(spans) if of]
            if changed:
                live = batch.column(2).to_pylist()
                texts = rows[text_col].to_pylist()
                lengths = rows[length_col].to_pylist() if length_col else None
                for n in changed:
                    told = [(s["start"], s["end"]) for s in spans[n] if s["kind"] != OWNED or s["value"] in live[n]]
                    if told:
                        texts[n] = mask(texts[n], told, put)
                        if length_col:
                            lengths[n] = len(texts[n])
                for name, values in ((text_col, texts), (length_col, lengths)):
                    if name:
                        at = rows.schema.get_field_index(name)
                        rows = rows.set_column(at, rows.schema.field(at), pa.array(values, rows.schema.field(at).type))
            yield rows

    return sure.union(rest).mapInArrow(replace, docs.schema)
