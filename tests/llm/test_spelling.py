import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from feedloom.llm.queries import op12_spelling
from feedloom.llm.spelling import _keys, runs, spelling_variants, variants, vocabulary

from .conftest import docs_of, odd_rows

LETTERS = "abzéØÞß×ÿ"


def one_edit(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) < len(b):
        a, b = b, a
    p = next((p for p, (x, y) in enumerate(zip(a, b)) if x != y), len(b))
    return a[p + 1:] == (b[p + 1:] if len(a) == len(b) else b[p:])


def expected(counts, ratio=2):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, around in near.items():
        best = min(around, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def counted(rows, drop_every=None):
    """Words and their occurrences, run by run."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    total = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if drop_every and h % drop_every == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            total[run] += 1
    return total


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("symbols", [2, 4, 6, 30])
def test_variants_equal_all_pairs(spark, symbols):
    rng = random.Random(symbols)
    counts = {"".join(rng.choice(LETTERS[:4]) for _ in range(rng.randint(1, 5))): rng.choice([1, 2, 3, 5, 8, 16, 40]) for _ in range(250)}
    counts |= {"".join(rng.choice(LETTERS) for _ in range(rng.randint(5, 12))): rng.randint(1, 9) for _ in range(100)}
    long = "".join(rng.choice(LETTERS) for _ in range(66))
    counts |= {long[:63]: 4, long[:64]: 9, long[1:65]: 3, long[:65]: 20, long[:64] + "q": 5, long[:63] + "q": 2, long: 50, long[1:]: 7}
    counts |= {"tie": 2, "tia": 9, "tib": 9, "ti": 9, "": 3}
    words = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long").repartition(3)
    assert found(variants(words, symbols)) == expected(counts)


@settings(max_examples=60)
@given(st.text(LETTERS, min_size=1, max_size=9), st.text(LETTERS, min_size=1, max_size=9), st.integers(2, 7), st.data())
def test_every_pair_meets_once(a, b, symbols, data):
    """Words at one edit share exactly one key in one direction, or both their own."""
    p = data.draw(st.integers(0, len(a)))
    other = data.draw(st.sampled_from([b, a[:p] + "z" + a[p:], a[:p] + a[p + 1:] or "q", a[:p] + "é" + a[p + 1:]]))
    own = [_keys([w], symbols)[1][0] for w in (a, other)]
    sent = [list(zip(*(x.tolist() for x in _keys([w], symbols, False)[1:]))) for w in (a, other)]
    for keys in sent:
        assert len(set(keys)) == len(keys) and keys[0][1] and not any(mine for _, mine in keys[1:])
    hits = [sum(k == own[1] for k, _ in sent[0]), sum(k == own[0] for k, _ in sent[1])]
    if one_edit(a, other):
        assert hits == [1, 1] if own[0] == own[1] else sorted(hits) == [0, 1]


def test_keys_of_several_words_are_those_of_each():
    words = ["abc", "", "zzzé", "b", "ababab"]
    place, key, own = _keys(words, 5, False)
    for n, word in enumerate(words):
        alone = _keys([word], 5, False)
        assert sorted(key[place == n].tolist()) == sorted(alone[1].tolist())
        assert own[place == n].sum() == 1


def test_runs_by_bytes():
    for i, text, *_ in odd_rows():
        assert {w.decode(): n for w, n in runs(i, (text or "").encode(), 3).items()} == counted([(i, text)], 3)
    assert runs(None, "ÀB×ÿ a1b".encode()) == {"Àb×ÿ".encode(): 1, b"a": 1, b"b": 1}


def test_vocabulary_of_odd_rows(spark, odd):
    got = {r.word: r.n for r in vocabulary(odd, least_length=1, least_count=1, drop_every=5).collect()}
    assert got == {w: n for w, n in counted(odd_rows(), 5).items() if w}


def test_whole_operator(spark):
    rng = random.Random(9)
    base = ["colour", "color", "colours", "theatre", "theater", "naïve", "naive", "straße", "strasse", "Ærø"]
    rows = [(i, " ".join(rng.choice(base) for _ in range(200)), "en", "a") for i in range(40)] + [(None, None, "en", "a"), (1, "", None, None)]
    counts = {w: n for w, n in counted(rows, 11).items() if len(w) >= 3 and n >= 2}
    assert found(spelling_variants(docs_of(spark, rows), least_length=3, least_count=2, drop_every=11)) == expected(counts)


def test_no_words(spark, none):
    assert found(spelling_variants(none)) == []
    assert found(spelling_variants(docs_of(spark, [(1, "1 2 3", "en", "a"), (2, None, None, None)]))) == []


def test_long_runs_and_long_texts(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("acgt") for _ in range(20_000))
    twin = long[:9000] + "x" + long[9000:]
    text = " ".join(["word", "words"] * 400_000)
    rows = [(1, f"{long} {twin} {long} {twin} {long} {twin} {long} {long} {long}", "en", "a"), (2, text, "en", "a")]
    assert len(text) > 4 << 20
    assert found(spelling_variants(docs_of(spark, rows), least_length=4)) == sorted([
        (long, None, long, 6, 1, None), (twin, long, long, 3, 1, 6),
        ("word", None, "word", 400_000, 1, None), ("words", None, "words", 400_000, 1, None)])


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    counts = {w: n for w, n in counted(rows, 97).items() if len(w) >= 5 and n >= 3}
    got = found(op12_spelling(spark, sf_dir))
    assert [r[0] for r in got] == sorted(counts) and {r[0]: r[3] for r in got} == counts
    some = sorted(counts)[::9]
    near = {w: sum(one_edit(w, x) for x in counts) for w in some}
    assert {r[0]: r[4] for r in got if r[0] in near} == near
