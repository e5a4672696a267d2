import re
import zlib
from collections import Counter
from math import log10

import pytest
from pyspark.sql import functions as F

from feedloom.llm import language_model
from feedloom.llm.language_id import held_out
from feedloom.llm.language_model import score_texts
from feedloom.llm.queries import op1_backoff
from tests.llm.conftest import odd_rows

END = None


def _tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


class Automaton:
    """States are n-grams, walked token by token with failure arcs."""

    def __init__(self, texts, order, strength):
        self.order, self.strength, self.count = order, strength, Counter()
        for text in texts:
            line = [END, *_tokens(text)]
            for at in range(1, len(line)):
                for n in range(1, order + 1):
                    if at - n + 1 >= 0:
                        self.count[tuple(line[at - n + 1:at + 1])] += 1
        # The end before a text is a state as often as there are texts: just as the end after it.
        self.n = sum(c for gram, c in self.count.items() if len(gram) == 1)
        self.v = sum(len(gram) == 1 for gram in self.count)

    def root(self, token):
        return (self.count[(token,)] + 1) / (self.n + self.v + 1)

    def arc(self, state, token):
        if not state:
            return self.root(token)
        return (self.count[(*state, token)] + self.strength * self.arc(state[1:], token)) / (self.count[state] + self.strength)

    def score(self, text):
        state, total = self._known((END,)[:self.order - 1]), 0.0
        for token in _tokens(text):
            failed = 0.0
            while state and not self.count[(*state, token)]:
                failed += log10(self.strength / (self.count[state] + self.strength))
                state = state[1:]
            total += failed + log10(self.arc(state, token))
            state = self._known((*state, token)[-(self.order - 1):] if self.order > 1 else ())
        return total

    def _known(self, state):
        while state and not self.count[state]:
            state = state[1:]
        return state


@pytest.mark.parametrize("order,block,shard", [(1, 1 << 22, 1 << 20), (2, 1 << 22, 1 << 20), (2, 700, 50), (3, 2000, 500), (4, 500, 100)])
def test_equals_a_walk_of_the_whole_automaton(odd, order, block, shard, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK", block)
    monkeypatch.setattr(language_model, "SHARD", shard)
    rows = odd_rows()
    trains = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2 for r in rows]
    model = Automaton([r[1] for r, ok in zip(rows, trains) if ok], order, 3.0)
    want = sorted(
        (str(r[0]), ok, len(_tokens(r[1])), sum(model.count[(t,)] > 0 for t in _tokens(r[1])), model.n,
         sum(log10(model.root(t)) for t in _tokens(r[1])), model.score(r[1])) for r, ok in zip(rows, trains))
    train = F.col("doc_id").isNotNull() & ~held_out("doc_id", 7, 2)
    got = sorted((str(r.id), r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in score_texts(odd, train, order=order, strength=3.0).collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_empty_table_and_no_training_rows(odd, none):
    assert score_texts(none, F.lit(True)).collect() == []
    for row in score_texts(odd, F.lit(False)).collect():
        assert (row.n_known, row.train_tokens, row.base_score, row.score) == (0, 0, 0.0, 0.0)


def test_probabilities_of_all_words_sum_to_one():
    model = Automaton(["a b a", "b b c", ""], 3, 2.0)
    words = [gram[0] for gram in model.count if len(gram) == 1]
    for state in [(), (END,), ("a",), ("b", "b"), (END, "a")]:
        # One more word, never seen, has what is left.
        assert sum(model.arc(state, w) for w in words) + model.arc(state, "never") == pytest.approx(1)


def test_query_knows_three_words(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    trains = [zlib.crc32(str(r.doc_id).encode()) % 7 != 2 for r in rows]
    model = Automaton([r.text for r, ok in zip(rows, trains) if ok], 3, 300.0)
    want = {r.doc_id: model.score(r.text) for r in rows[:40]}
    got = {r.doc_id: r.score for r in op1_backoff(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for doc_id, score in want.items():
        assert got[doc_id] == pytest.approx(score, rel=1e-9)
