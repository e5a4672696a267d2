"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.common import saved, table
from feedloom.llm.decontamination import without_leaks
from feedloom.llm.language_id import identified, train
from feedloom.llm.packing import pack
from feedloom.llm.queries import tokenizer
from feedloom.llm.secrets import without_secrets
from feedloom.llm.simhash import one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language a model trained on the labelled ones tells; null and letterless texts go.

    Null labels are not learned from. Repeated rows stay each. Of an empty table nothing is learned and no row comes out.
    """
    return identified(docs, train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id.

    Null ids come last, rows that repeat id and text are one. Null and empty texts are copies of each other. Null in other
    columns stays as it is. An empty table gives no rows.
    """
    return one_of_each(docs, shingle=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark passages are cut out; a document of which no word is left goes.

    Null and empty texts, and those without a passage, stay as they are, with all columns; repeated rows stay each. An empty
    benchmark cuts nothing, an empty table gives no rows.
    """
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), length_col="n_chars", window=10)


def secretless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced; no document goes.

    Null text stays null, a null source is an owner of its own, repeated rows stay each and count once. An empty table gives no rows.
    """
    return without_secrets(docs, length_col="n_chars", max_owners=2)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the sequences of 1024 tokens.

    Null and empty texts have one token, the end. Null ids stay null, repeated rows are packed each. An empty table gives no rows.
    """
    return pack(docs, tokenizer(), capacity=1024, end_id=0, added=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", secretless),
    ("packing", packed),
]

#: Fingerprints, suffix indexes and trained models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return docs
