import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, strategies as st

from feedloom.llm import repeats, words
from feedloom.llm.coding import ascending, planes, ranges, reascending, unplanes, within
from feedloom.llm.queries import SQL, op11_repeats
from feedloom.llm.repeats import rolling, without_repeats

from .conftest import docs_of, odd_rows


def expected(rows, window):
    """(id, words, removed, kept) of each row by comparing all windows; ids that repeat count as one document."""
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    least = {}
    for i, w in texts:
        for p in range(len(w) - window + 1):
            place, key = (i is not None, i or 0, p), tuple(w[p:p + window])
            least[key] = min(least.get(key, place), place)
    out = []
    for i, w in texts:
        gone = set()
        for p in range(len(w) - window + 1):
            if least[tuple(w[p:p + window])] < (i is not None, i or 0, p):
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted((tuple(r) for r in without_repeats(docs, **options).collect()), key=str)


def passages(count=200, seed=3):
    """Texts of few words and shared passages, with nulls, copies and repeated rows."""
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcde") for _ in range(rng.randint(5, 60))) for _ in range(6)]
    rows = [(None, None, "en", "a"), (None, shared[0], "en", "a"), (None, shared[0], "en", "a"), (7, "", "en", "a")]
    for i in range(10, 10 + count):
        parts = [rng.choice(shared) if rng.random() < 0.4 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40)))
                 for _ in range(rng.randint(0, 5))]
        rows.append((i, rng.choice([" ", "\n", " \t\r\n"]).join(parts), "en", "a"))
    rng.shuffle(rows)
    return rows + [rows[5], rows[9]]


@pytest.mark.parametrize("window, parts, shard", [(20, 6, 1 << 22), (20, 3, 300), (10, 5, 500), (4, 2, 2000), (2, 3, 1 << 22)])
def test_equals_all_windows(spark, monkeypatch, window, parts, shard):
    monkeypatch.setattr(repeats, "SHARD", shard)
    rows = passages()
    assert found(docs_of(spark, rows, parts), window=window) == expected(rows, window)


def test_odd_rows(spark, odd):
    assert found(odd, window=20) == expected(odd_rows(), 20)


def test_empty_table_and_odd_window(none):
    assert found(none) == []
    with pytest.raises(ValueError, match="even"):
        without_repeats(none, window=5)


def test_text_beyond_a_chunk(spark):
    rng = random.Random(1)
    long = [f"w{rng.randrange(10**6)}" for _ in range(700_000)]
    text = " ".join(long)
    assert len(text) > repeats.CHUNK
    rows = [(1, text, "en", "a"), (2, " ".join(["own"] * 5 + long[500_000:500_040] + ["end"]), "en", "a")]
    got = found(docs_of(spark, rows, 2))
    assert [r[:3] for r in got] == [(1, 700_000, 0), (2, 46, 41 - 1)]
    assert got[1][3] == "own own own own own end" and got[0][3] == text


def test_half_of_all_texts_equal(spark):
    """A task gets as much of one passage as of others: each chunk tells it once."""
    same = " ".join(f"s{i}" for i in range(60))
    rows = [(i, same if i % 2 else " ".join(f"{i}x{j}" for j in range(60)), "en", "hot") for i in range(4000)]
    got = {r[0]: r for r in found(docs_of(spark, rows, 8))}
    assert got[1][2] == 0 and all(got[i][2] == (60 if i % 2 and i > 1 else 0) for i in range(4000))
    chunk = repeats.Texts(
        *(lambda data, offsets: (data, *words.spans(data, offsets, words.SPACED)))(
            np.frombuffer((same + "\n").encode() * 500, np.uint8), np.arange(501) * (len(same) + 1)), ids=None)
    told = list(repeats._Anchors(chunk, 20, 1).questions())
    assert sum(len(a) + len(c) for _, a, _, c in told) == 4 * 51


@given(st.lists(st.integers(0, 2**64 - 1), unique=True))
def test_numbers_as_planes(values):
    values = np.sort(np.array(values, np.uint64))
    assert reascending(ascending(values), "<u8").tolist() == values.tolist()
    for shards in (1, 3, 1000):
        spans = ranges(values, shards)
        assert [x for _, a, b in spans for x in values[a:b].tolist()] == values.tolist()
        for shard, a, b in spans:
            short = within(values[a:b], shard, shards, 32).tolist()
            assert short == sorted(short) and max(short) < 1 << 32
    small = (values >> np.uint64(40)).astype("<u4")
    assert unplanes(planes(small), "<u4").tolist() == small.tolist()


@given(st.lists(st.integers(0, 3), max_size=30), st.integers(1, 12))
def test_rolling_hashes_tell_runs_apart(values, size):
    hashed = words.mix(np.array(values, np.uint64))
    got = rolling(hashed, size).tolist()
    runs = [tuple(values[i:i + size]) for i in range(len(values) - size + 1)]
    assert len(got) == len(runs)
    assert all((got[i] == got[j]) == (runs[i] == runs[j]) for i in range(len(runs)) for j in range(i))


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    wanted = sorted(((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in expected(rows, 20)), key=str)
    assert sorted((tuple(r) for r in op11_repeats(spark, sf_dir).collect()), key=str) == wanted
    assert sum(r[2] for r in wanted) > 0 and "op11_repeats" in SQL
