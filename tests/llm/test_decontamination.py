import random
import re

import numpy as np
import pytest
from hypothesis import given, strategies as st

from feedloom.llm import decontamination
from feedloom.llm.decontamination import find_leaks, without_leaks
from feedloom.llm.fm_index import FMIndex

from .conftest import docs_of, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return [(m[0], m.start(), m.end()) for m in WORD.finditer(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]


def brute(text, items, window=10):
    words = words_of(text)
    hit, found = set(), set()
    for item, item_text in items:
        own = [w for w, _, _ in words_of(item_text)]
        n = min(window, len(own))
        for at in range(len(own) - n + 1) if n else ():
            for p in range(len(words) - n + 1):
                if [w for w, _, _ in words[p:p + n]] == own[at:at + n]:
                    hit.update(range(p, p + n))
                    found.add(str(item))
    return len(words), len(hit), sorted(found), [words[p][1] for p in sorted(hit)]


@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 4))
def test_index_finds_every_occurrence(runs, length):
    text = np.array([x for run in runs for x in [0, *run]] + [0])
    patterns = np.array(np.meshgrid(*[[1, 2, 3, 4]] * length)).reshape(length, -1).T
    which, position = FMIndex(text).search(patterns)
    expected = {(k, p) for k, pattern in enumerate(patterns.tolist())
                for p in range(len(text) - length + 1) if text[p:p + length].tolist() == pattern}
    assert sorted(zip(which.tolist(), position.tolist())) == sorted(expected)


def cases():
    rng = random.Random(8)
    words = ["the", "of", "a", "Snow", "été", "x1", "漢字"]
    items = [(n, " ".join(rng.choice(words) for _ in range(rng.randint(5, 25)))) for n in range(12)]
    items += [(20, "only three words"), (21, ""), (22, None), (23, "?!"), (20, "only three words"), (None, "nameless item of few"), (9, "Snow")]
    docs = odd_rows()[:30]
    for n in range(100, 130):
        item = (rng.choice(items)[1] or "").upper().replace(" ", " - ")
        docs.append((n, " ".join(rng.choice(words) for _ in range(40)) + "; " + item + ", " + rng.choice(words), "en", "s"))
    docs.append((200, "é Only THREE, words. only three words only three words", "en", "s"))
    return items, docs


@pytest.mark.parametrize("part", [1 << 23, 300])
def test_against_brute_force(spark, monkeypatch, part):
    """Also with a benchmark in several parts."""
    monkeypatch.setattr(decontamination, "BENCHMARK_BYTES", part)
    items, docs = cases()
    items = items[:-1]  # the item of one frequent word would hit everything
    got = find_leaks(docs_of(spark, docs), spark.createDataFrame(items, "item_id int, text string")).collect()
    texts = {}
    for i, t, _, _ in docs:
        texts[i] = t
    assert len(got) == len(docs)
    for r in got:
        n_words, n_hit, found, places = brute(texts[r.id], [(i if i is not None else "", t) for i, t in items])
        assert (r.n_words, r.n_hit, list(r["items"])) == (n_words, n_hit, found), r.id
        inside = [p for s in r.spans for p in places if s.start <= p < s.end]
        assert inside == places
    assert sum(bool(r.n_hit) for r in got) > 10


@pytest.mark.parametrize("part", [1 << 23, 300])
def test_removal_leaves_no_window_and_all_else(spark, monkeypatch, part):
    monkeypatch.setattr(decontamination, "BENCHMARK_BYTES", part)
    items, docs = cases()
    benchmark = spark.createDataFrame(items[:-1], "item_id int, text string")
    rows = docs_of(spark, docs)
    kept = {r.doc_id: r for r in without_leaks(rows, benchmark, length_col="n_chars").collect()}
    texts = {i: t for i, t, _, _ in docs}
    named = [(i if i is not None else "", t) for i, t in items[:-1]]
    for i, text in texts.items():
        if not brute(text, named)[1]:
            assert kept[i].text == text
        elif i in kept:
            assert brute(kept[i].text, named)[1] == 0 and words_of(kept[i].text)
            assert kept[i].n_chars == len(kept[i].text) and kept[i].id == "x"
    assert 200 not in kept or kept[200].text.split()[0] == "é"


def test_empty_tables(spark, none):
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    assert find_leaks(none, benchmark).collect() == []
    got = find_leaks(docs_of(spark, odd_rows()), benchmark.limit(0)).collect()
    assert len(got) == len(odd_rows()) and not any(r.n_hit for r in got)
    assert without_leaks(none, benchmark).collect() == []


def test_benchmark_above_a_part(spark):
    """More text than is sent to the tasks together; parts and whole find the same."""
    rng = random.Random(6)
    items = [(n, " ".join(f"w{rng.randrange(3000)}" for _ in range(1500))) for n in range(900)]
    assert sum(len(t) for _, t in items) > decontamination.BENCHMARK_BYTES // 2
    benchmark = spark.createDataFrame(items, "item_id int, text string").union(
        spark.createDataFrame([(n + 1000, t + " end") for n, t in items[:500]], "item_id int, text string"))
    docs = [(n, "x " * 5 + " ".join(items[n * 7][1].split()[40:70]) + " y z", "en", "a") for n in range(30)] + [(99, "x y z", "en", "a"), (98, None, None, None)]
    got = find_leaks(docs_of(spark, docs), benchmark).collect()
    for r in got:
        n = r.id
        want = (0, []) if n > 50 else (30, sorted(str(i) for i in (7 * n, *([7 * n + 1000] if 7 * n < 500 else []))))
        assert (r.n_hit, list(r["items"])) == want
        assert [(s.start, s.end) for s in r.spans] == ([(10, len(docs[n][1]) - 4)] if n < 50 else [])
    kept = {r.doc_id: r.text for r in without_leaks(docs_of(spark, docs), benchmark).collect()}
    assert kept == {**{n: "x " * 5 + " y z" for n in range(30)}, 99: "x y z", 98: None}
