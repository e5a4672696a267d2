import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from feedloom.llm import language_id
from feedloom.llm.language_id import Ftrl, held_out, identified, predict, train
from tests.llm.conftest import docs_of, odd_rows

WORDS = {
    "en": "the of and river house when snow winter thing through would",
    "de": "der die und straße schnee über nicht fluß zwölf möchte",
    "es": "el los río nieve año mañana también invierno corazón según",
}


def _rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(3, 60))), lang, "s"))
    return out


def test_held_out_accuracy(spark):
    docs = docs_of(spark, _rows(400) + [(1000 + i, "copied der the el " * 5, "en", "s") for i in range(300)])
    test = held_out("doc_id", 3, 1)
    model = train(docs.where(~test))
    assert model.labels == ["de", "en", "es"] and (model.weights == 0).mean() > 0.3
    got = predict(docs.where(test & (F.col("doc_id") < 400)), model).join(docs.select(F.col("doc_id").alias("id2"), "lang"), F.col("id") == F.col("id2"))
    rows = got.collect()
    assert np.mean([r.label == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd, none):
    model = train(docs_of(spark, _rows(100)))
    got = predict(odd, model).collect()
    assert len(got) == len(odd_rows())
    texts = {r[0]: r[1] for r in odd_rows()}
    for r in got:
        unknown = not any(map(str.isalpha, texts[r.id] or ""))
        assert (r.label == "und") == unknown and (r.score == 0) == unknown
    kept = identified(odd, model, min_score=0.0)
    assert kept.columns == odd.columns and kept.count() == sum(any(map(str.isalpha, t or "")) for _, t, _, _ in odd_rows())
    assert predict(none, model).collect() == [] and identified(none, model).collect() == []
    unlearned = train(none)
    assert {r.label for r in predict(odd, unlearned).collect()} == {"und"}


def test_label_of_copies_is_learned(spark, monkeypatch):
    rng = random.Random(4)
    learned, learn = Counter(), Ftrl.learn

    def counted(self, features, values, label):
        learned[label] += 1
        learn(self, features, values, label)

    def text(lang):
        return " ".join(rng.choice(WORDS[lang].split()) for _ in range(30))

    monkeypatch.setattr(Ftrl, "learn", counted)
    few = [text("es") for _ in range(20)]
    rows = [(lang, text(lang)) for lang in ("en", "de") for _ in range(60)] + [("es", few[n % 20]) for n in range(4000)]
    model = train(docs_of(spark, [(n, t, lang, "s") for n, (lang, t) in enumerate(rows)]), sample=40, passes=1)
    # All 20 texts are in the sample; about a fifth of it is held back.
    assert learned[model.labels.index("es")] >= 12
    assert set(model.predict([text("es") for _ in range(20)])[0]) == {"es"}


def _plain(text):
    """(order, n-gram) at each place, read one by one."""
    line = "".join(" " if c.isascii() and not c.isalpha() else c for c in text.lower()) + "   "
    return [[line[at:at + n].ljust(n, "\0") for at in range(len(line))] for n in (1, 2, 3)]


def test_features_are_those_of_each_ngram():
    texts = ["Ab1 çÉ", "", "a.b!a b", "漢字 x" * 3]
    found, firsts, ends = language_id.grams(texts)
    held = {}
    for text, a, b in zip(texts, firsts.tolist(), ends.tolist()):
        for n, ngrams in enumerate(_plain(text)):
            assert len(ngrams) == b - a
            for ngram, feature in zip(ngrams[:b - a - n], found[n][a:b]):
                assert held.setdefault((n, ngram), int(feature)) == feature < language_id.FEATURES
    assert len(set(held.values())) > 0.9 * len(held)


def test_learner_step_by_step():
    learner, z, n = Ftrl(3, 0.3, 1.0, 0.02, 0.1), {}, {}

    def weight(f, k):
        lead = max(abs(z.get((f, k), 0.0)) - 0.02, 0.0) * (1 if z.get((f, k), 0.0) > 0 else -1)
        return -lead / ((1.0 + n.get((f, k), 0.0) ** 0.5) / 0.3 + 0.1)

    rng = random.Random(6)
    for _ in range(40):
        features = sorted(rng.sample(range(8), 4))
        values, label = [rng.random() for _ in features], rng.randrange(3)
        logits = [sum(v * weight(f, k) for f, v in zip(features, values)) for k in range(3)]
        odds = [math.exp(x) / sum(map(math.exp, logits)) for x in logits]
        for f, v in zip(features, values):
            for k in range(3):
                w, g, before = weight(f, k), v * (odds[k] - (k == label)), n.get((f, k), 0.0)
                z[f, k] = z.get((f, k), 0.0) + g - ((before + g * g) ** 0.5 - before ** 0.5) / 0.3 * w
                n[f, k] = before + g * g
        learner.learn(np.array(features), np.array(values), label)
    want = np.array([[weight(f, k) for k in range(3)] for f in range(8)])
    assert np.allclose(learner.weights(np.arange(8)), want) and (want != 0).any()


def test_prediction_is_the_softmax_over_ngrams():
    rng = np.random.default_rng(3)
    model = language_id.Model(["x", "y"], rng.normal(size=(2, language_id.FEATURES)).astype(np.float32), 0.7)
    for text in ("Hello wörld 12", "a", "zz top"):
        found, _, _ = language_id.grams([text])
        share = Counter(int(f) for order in found for f in order)
        logits = [sum(float(w[f]) * c for f, c in share.items()) / sum(share.values()) / 0.7 for w in model.weights]
        odds = [math.exp(v) / sum(map(math.exp, logits)) for v in logits]
        (label,), (score,) = model.predict([text])
        assert label == "xy"[int(np.argmax(odds))] and abs(score - max(odds)) < 1e-6


def test_temperature_is_the_likeliest():
    logits, labels = np.array([[2.0, 0.0], [0.5, 0.0], [0.0, 1.0], [3.0, 0.0]]), np.array([0, 1, 1, 0])
    aim = [[1 / 6, 5 / 6] if k else [5 / 6, 1 / 6] for k in labels]

    def loss(t):
        return -sum(a * math.log(math.exp(x / t) / sum(math.exp(y / t) for y in row)) for row, of in zip(logits.tolist(), aim) for x, a in zip(row, of))

    found = language_id._temperature(logits, labels)
    assert loss(found) <= min(loss(t) for t in np.geomspace(0.05, 20, 400)) + 1e-3


def test_six_hundred_languages(spark, monkeypatch):
    """More labels share the sample; none is left out."""
    monkeypatch.setattr(language_id, "SAMPLE_OF_ALL", 6000)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 1200)]
    rows = [(i, (letters[2 * k] + letters[2 * k + 1]) * (3 + i % 4), f"l{k}", "s") for i, k in enumerate(list(range(600)) * 6)]
    model = train(docs_of(spark, rows))
    assert len(model.labels) == 600
    label, _ = model.predict([(letters[2 * k] + letters[2 * k + 1]) * 5 for k in range(600)])
    assert sum(said == f"l{k}" for k, said in enumerate(label)) > 0.7 * 600
