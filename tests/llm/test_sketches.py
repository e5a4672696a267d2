import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.llm import sketches as sk
from feedloom.llm.common import bytes_of
from tests.llm.conftest import docs_of, odd_rows


def _shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def _like(a, b):
    a, b = _shingles(a), _shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def _sketch(*texts, k=sk.K):
    return sk.sketches(*bytes_of(pa.array(texts)), k)


def test_exact_for_short_texts_and_near_for_long():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    for size, error in ((30, 1e-9), (4000, 0.15)):
        a = [rng.choice(words) for _ in range(size)]
        for share in (0.0, 0.3, 0.7, 1.0):
            b = a[:int(size * share)] + [rng.choice(words) for _ in range(size - int(size * share))]
            x, y = _sketch(" ".join(a), " ".join(b))
            assert sk.resemblance(x, y) == pytest.approx(_like(" ".join(a), " ".join(b)), abs=error)
            both = _shingles(" ".join(a))
            assert sk.distinct(x) == pytest.approx(len(both), rel=0.3)
            within = len(both & _shingles(" ".join(b))) / len(both)
            assert sk.containment(x, y) == pytest.approx(within, abs=0.02 if size == 30 else 0.25)
            assert np.array_equal(sk.unpacked(sk.packed(x)), x)


def test_repeats_do_not_hide_shingles():
    text = " ".join(["a b c d e f g"] * 3000 + [f"x{i}" for i in range(3000)])
    (found,) = _sketch(text)
    everything = _sketch(text, k=10 ** 6)[0]
    assert len(everything) == len(_shingles(text))
    assert np.array_equal(found, everything[:sk.K])


def test_sketches_of_parts_merge(spark, odd):
    rows = sk.sketched(odd).withColumn("part", F.col("id") % 3)
    want = {}
    for r in rows.collect():
        want[r.part] = sk.merge(want.get(r.part, np.zeros(0, np.uint64)), sk.unpacked(r.sketch))
    got = {r.key: sk.unpacked(r.sketch) for r in sk.merged(rows, "part").collect()}
    assert got.keys() == want.keys()
    assert all(np.array_equal(got[k], want[k]) for k in got)


@pytest.mark.parametrize("parts", [1, 4])
def test_each_text_beside_the_next(spark, parts):
    rows = odd_rows()
    texts = [(r[0], r[1] or "") for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))]
    want = []
    for (i, text), (_, after) in zip(texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        a, b, c = _sketch(text, new, after)
        want.append((str(i), len(text), hashlib.sha256(new.encode()).hexdigest(), sk.packed(a), sk.packed(b),
                     sk.resemblance(a, b), sk.resemblance(a, c)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sk.compared_with_next(docs_of(spark, rows, parts)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((str(r[0]), *r[1:3], bytes(r[3]), bytes(r[4]), *r[5:]) for r in got) == sorted(want)


def test_one_row_and_none(spark, none):
    assert sk.compared_with_next(none).collect() == []
    (row,) = sk.compared_with_next(docs_of(spark, [(1, "a b c d e f", "en", "x")])).collect()
    assert (row.near_next, row.edited_sha256) == (1.0, hashlib.sha256(b"a b c " + b"a b c").hexdigest())
