"""A text longer than any block, chunk or shard goes through the operators whole."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm.decontamination import find_leaks
from feedloom.llm.language_model import score_texts
from feedloom.llm.sketches import compared_with_next
from feedloom.llm.token_file import round_trip

from .conftest import docs_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    words = [f"word{n}" for n in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(700_000))
    assert len(long) > 5 << 20
    return {1: "before it", 2: long, 3: "after it", 4: long[1 << 20:(1 << 20) + 5000]}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return docs_of(spark, [(i, t, "en", "a") for i, t in texts.items()], 2)


def test_scores(docs, texts):
    got = {r.id: r for r in score_texts(docs, F.col("doc_id") != 4, order=3).collect()}
    assert {i: r.n_tokens for i, r in got.items()} == {i: len(t.split()) + 1 for i, t in texts.items()}
    assert got[2].train_tokens == 700_000 + 1 + 2 * 3 and got[4].n_known >= got[4].n_tokens - 2
    # What it has seen word by word is likelier than by its words alone.
    assert got[4].score > 0.8 * got[4].base_score and got[2].score > got[2].base_score


def test_leaks(spark, docs, texts):
    end = " ".join(texts[2].split()[-15:])
    got = {r.id: r for r in find_leaks(docs, spark.createDataFrame([(9, end)], "item_id int, text string")).collect()}
    assert (got[2].n_words, got[2].n_hit) == (700_000, 15) and got[2].spans[-1].end == len(texts[2])
    assert got[1].n_hit == got[3].n_hit == 0


def test_sketches(docs, texts):
    got = {r.id: r for r in compared_with_next(docs).collect()}
    half = len(texts[2]) // 2
    assert got[2].n_chars == len(texts[2])
    assert got[2].edited_sha256 == hashlib.sha256((texts[2][:len(texts[2]) - half] + texts[3][:half]).encode()).hexdigest()
    assert 0.3 < got[2].near_edited < 0.7


def test_token_files(docs, texts):
    library = Tokenizer.from_file(PATH)
    got = {r.id: r for r in round_trip(docs, PATH, end_id=2, added=True).collect()}
    for i, text in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].n_tokens, got[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
