"""Half of all rows on one key: nothing is gathered in one task. Adaptive execution and broadcast by size are off."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from feedloom.llm import packing, simhash, sketches
from feedloom.llm.common import spread_join
from feedloom.llm.components import stars
from feedloom.llm.packing import pack
from feedloom.llm.secrets import find_secrets
from feedloom.llm.token_file import write_tokens
from feedloom.llm.url_filter import propagated

from .conftest import docs_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(autouse=True)
def plain(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def uneven(df):
    """Rows of the fullest part over the mean of those with rows."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / (sum(counts) / len(counts))


def test_spread_join(spark):
    rows = spark.range(0, 8000, 1, 8).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id") % 3000).alias("k"), "id")
    one = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = spread_join(rows, one, ["k"])
    assert uneven(got) < 2
    top = {r.k: r.top for r in one.collect()}
    assert Counter((r.k, r.id, r.top) for r in got.collect()) == Counter((r.k, r.id, top[r.k]) for r in rows.collect())
    assert spread_join(rows.limit(0), one.limit(0), ["k"]).collect() == []
    assert spread_join(rows, one.where("k < 0"), ["k"]).count() == 4000


def test_sketches_of_null_ids(spark):
    rows = [(None if n % 2 else n, f"text number {n} of many", "en", "a") for n in range(4000)]
    docs = docs_of(spark, rows, 8)
    got = sketches.compared_with_next(docs)
    assert got.count() == 4000
    parts = Counter(r.p for r in got.select(F.spark_partition_id().alias("p")).collect())
    assert max(parts.values()) < 2.5 * 4000 / 8  # stretches of an eighth of a part's rows, dealt by hash


def test_token_files_of_null_ids(spark, work):
    rows = [(None if n % 2 else n, f"text number {n} of many", "en", "a") for n in range(4000)]
    files = write_tokens(docs_of(spark, rows, 8), f"{work}/tokens", PATH).collect()
    assert sum(f.docs for f in files) == 4000 and max(f.docs for f in files) < 2 * 4000 / 8


def test_packing_of_equal_rows(spark):
    rows = [(7 if n % 2 else n, "the same text" if n % 2 else f"text {n}", "en", "a") for n in range(4000)]
    got = pack(docs_of(spark, rows, 8), PATH, group=200).collect()
    assert sum(r.length for r in got) == sum(r.doc_tokens for r in got if r.start == 0)
    sizes = Counter(r.sequence_id >> 32 for r in got)
    assert len(sizes) == 20 and max(sizes.values()) < 2 * len(got) / len(sizes)


def test_each_piece_goes_where_the_rule_says():
    """Descending, to the cheapest sequence with room for the whole, else the cheapest with any: against a plain search."""
    rng = np.random.default_rng(4)
    for _ in range(30):
        lengths = rng.integers(1, 100, rng.integers(0, 60))
        (document, start, length, sequence, offset), count = packing.balance(lengths, 100, 1.0, 0.01)
        room, spent, want = [100] * count, [0.0] * count, []
        for d in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
            left, at = int(lengths[d]), 0
            while left:
                whole = [s for s in range(count) if room[s] >= left]
                s = min(whole or [s for s in range(count) if room[s]], key=lambda s: (spent[s], s))
                n = min(left, room[s])
                want.append((d, at, n, s, 100 - room[s]))
                room[s] -= n
                spent[s] += n + 0.01 * n * n
                left, at = left - n, at + n
        assert list(zip(*(x.tolist() for x in (document, start, length, sequence, offset)))) == want


def test_copied_secret(spark):
    shared = "Zx9Qw8Er7Ty6Ui5Op4As3"
    rows = [(n, f"a {shared} b" if n % 2 else f"token = Ab{n}xYz{n}Qq", "en", f"o{n % 50}") for n in range(4000)]
    got = find_secrets(docs_of(spark, rows, 8), max_owners=2).collect()
    assert all(len(r.spans) == (0 if r.id % 2 else 1) for r in got)


def test_copies_and_empty_texts(spark):
    rows = [(n, "" if n % 2 else f"w{n} x{n} y{n} z{n} v{n}", "en", "a") for n in range(4000)]
    got = simhash.near_duplicates(docs_of(spark, rows, 8), max_bits=0)
    assert uneven(got) < 2
    assert {r.component_id for r in got.where("fingerprint = 0").collect()} == {1} and got.count() == 4000


def test_star_of_one_node(spark):
    edges = spark.range(1, 6001, 1, 8).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b")).union(
        spark.range(7000, 9000, 2, 2).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    got = {r.a: r.b for r in stars(edges).collect()}
    assert got == {**{n: 0 for n in range(1, 6001)}, **{n + 1: n for n in range(7000, 9000, 2)}}


def test_links_of_a_hub(spark):
    links = spark.range(1, 4001, 1, 8).select(F.lit("hub").alias("a"), F.concat(F.lit("h"), "id").alias("b"), F.lit(1).alias("n")).union(
        spark.range(1, 2001, 1, 4).select(F.concat(F.lit("h"), "id").alias("a"), F.concat(F.lit("g"), "id").alias("b"), F.lit(2).alias("n")))
    seeds = spark.createDataFrame([("hub", 1.0, 0.0), ("g5", 0.0, 0.5)], "host string, trust double, distrust double")
    got = {r.host: (r.trust, r.distrust) for r in propagated(seeds, links).collect()}
    assert got["hub"][0] == pytest.approx(0.15) and got["h9"][0] == pytest.approx(0.15 * 0.85 / 4000)
    assert got["g9"][0] == pytest.approx(0.15 * 0.85 ** 2 / 4000) and got["h5"][1] == pytest.approx(0.075 * 0.85)
    assert got["hub"][1] == pytest.approx(0.075 * 0.85 ** 2)
