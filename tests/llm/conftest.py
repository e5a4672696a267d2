import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row string, fingerprint string, text_key string"


def docs_of(spark, rows, parts=3):
    """Documents (doc_id, text, lang, source) with further columns whose names clash with inner ones."""
    full = [(i, t, l, s, None if t is None else len(t), "x", "y", "z", "w") for i, t, l, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def odd_rows():
    """Nulls, empty and blank texts, repeated rows, equal texts, one very long text, letters beyond ASCII."""
    rng = random.Random(5)
    words = ["the", "Of", "élan", "straße", "x1", "naïve", "don't", "snow", "漢字", "😀", "a b", "42"]
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one two", "en", "b"),
        (5, "ONE  Two", "fr", "b"), (None, "no id here at all, none", "en", None), (7, "...!!", None, "c"),
        (8, " ".join(rng.choice(words) for _ in range(30_000)), "en", "c"), (9, "<|endoftext|> in  text\r\n\n x", "de", "c"),
    ]
    for i in range(10, 60):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 400))), "en", f"s{i % 3}"))
    return rows + [rows[3], rows[12], (60, rows[12][1], "en", "d"), (61, "x" * 5000, "en", "d")]


@pytest.fixture(scope="session")
def odd(spark):
    return docs_of(spark, odd_rows())


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
