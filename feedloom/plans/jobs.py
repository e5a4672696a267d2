"""The five jobs: publish users, keep users by key, keep users as documents, summarise
numbers, export news."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from feedloom.operators.articles import NEWS, Layout, checked, listed_articles, told_articles
from feedloom.operators.decode import decode
from feedloom.operators.enrich import enrich
from feedloom.operators.flatten import complete, flatten_users
from feedloom.operators.stats import numeric_stats, scaled
from feedloom.operators.validity import is_uuid, split_valid, tagged
from feedloom.schemas import (
    ARTICLE_FIELDS, CREATED_USER, ENVELOPE, USER_DATABASE, USER_FIELDS, USER_TABLE, USER_TOPIC,
)
from feedloom.sinks.batches import append_sink, batch_folder
from feedloom.sinks.csv import export_csv
from feedloom.sinks.catalog import create_namespace, replace_table
from feedloom.sources.pages import read_payloads
from feedloom.sources.topics import publish, read_topic
from feedloom.live import runs
from feedloom.live.state import keep_latest, latest_rows

# Arrival order of messages; it decides which of two writes of a key is the later one.
ARRIVAL = ["timestamp", "partition", "offset"]


@dataclass(frozen=True)
class Topic:
    """Where messages are: a Kafka topic, or files below ``path``."""

    name: str = USER_TOPIC
    path: str | None = None
    options: Mapping[str, str] | None = None

    def stream(self, spark: SparkSession) -> DataFrame:
        return read_topic(spark, self.name, path=self.path, options=self.options)


def publish_users(
    payloads: DataFrame, topic: Topic = Topic(), rejected: str | None = None, *, batch_id: int = 0,
    run: str | None = None,
) -> None:
    """API responses (column ``raw``) to flat user messages.

    A response that lacks a field is not published; with ``rejected`` it is
    kept there with the paths it lacks. A ``run`` and a ``batch_id`` name the
    batch: published again, it replaces itself there and in a topic of files.
    """
    run = run or uuid.uuid4().hex
    flat = flatten_users(payloads.select("raw"), typed_postcode=True)
    if rejected:
        flat = flat.persist()
    try:
        good, bad = split_valid(flat, {"missing path": complete()})
        publish(good.select(*USER_FIELDS), topic.name, path=topic.path, options=topic.options,
                batch_id=batch_id, run=run)
        if rejected:
            bad.select("raw", "missing").write.mode("overwrite").parquet(batch_folder(rejected, batch_id, run))
    finally:
        flat.unpersist()


def publish_responses(
    spark: SparkSession, path: str, topic: Topic, checkpoint_root: str, *, rejected: str | None = None,
    every: str | None = None, available_now: bool = False, options: Mapping[str, str] | None = None,
):
    """API responses that arrive as files of lines, published as flat user messages batch after batch.

    Lines that lack a field go to ``rejected``, if named. A batch played again replaces itself in a topic
    of files; Kafka gets it again, as from any writer of batches.
    """
    def sink(batch: DataFrame, batch_id: int, run: str) -> None:
        publish_users(batch, topic, rejected, batch_id=batch_id, run=run)

    return runs.start(
        read_payloads(spark, path, stream=True, options=dict(options or {})), "publish_responses", sink,
        target=topic.name, checkpoint_root=checkpoint_root, every=every, available_now=available_now)


def publish_paced(
    numbered: DataFrame, topic: Topic, checkpoint_root: str, *, per_batch: int, every: str | None = None,
):
    """Publish records in the order of their ``position``, ``per_batch`` with each batch, a batch ``every`` so often.

    ``numbered`` is what ``positions.store_numbered`` gives; a batch reads its part of the files alone. The pace is that of
    Spark's source of counted batches: a start on the same checkpoint goes on where the last one ended, and the
    query runs on, without records in the end, until it is stopped (``runs.run_batches``).
    """
    columns = [name for name in numbered.columns if name != "position"]
    pace = numbered.sparkSession.readStream.format("rate-micro-batch").option("rowsPerBatch", per_batch).option(
        "numPartitions", 1).load()

    def sink(batch: DataFrame, batch_id: int, run: str) -> None:
        first, last = batch.agg(F.min("value"), F.max("value")).head()
        if first is not None:
            now = numbered.filter(F.col("position").between(first, last)).select(*columns)
            publish(now, topic.name, path=topic.path, options=topic.options, batch_id=batch_id, run=run)

    return runs.start(pace, "publish_paced", sink, target=topic.name, checkpoint_root=checkpoint_root, every=every)


def created_users(spark: SparkSession, checkpoint_root: str) -> DataFrame:
    """The user table that ``users_to_table`` keeps, as of its last batch."""
    return latest_rows(spark, checkpoint_root, "users_to_table", _KEPT_USER, "id", ARRIVAL).select(
        *CREATED_USER.fieldNames())


_KEPT_USER = T.StructType([*CREATED_USER.fields, *[ENVELOPE[name] for name in ARRIVAL]])


def user_rules() -> dict[str, Column]:
    return {"no id": F.col("id").isNotNull(), "id is no UUID": is_uuid(F.col("id"))}


def users_to_table(
    spark: SparkSession,
    topic: Topic,
    checkpoint_root: str,
    *,
    field_aliases: Mapping[str, str] | None = None,
    key_expr: Mapping[str, Column] | None = None,
    sink: runs.BatchSink | None = None,
    target: str = "state",
    every: str | None = None,
    available_now: bool = False,
):
    """User messages to a table of one row for each valid key, the last arrival: ``created_users``.

    The messages carry no ``id`` and spell ``post_code`` differently: without
    ``key_expr`` no row has a key, without ``field_aliases`` the post code is NULL. Rows without a valid key are
    left to ``users_rejected``. ``sink`` gets the rows that each batch changes, to replace them by key in ``target``.
    """
    rows = decode(
        topic.stream(spark), CREATED_USER,
        field_aliases=field_aliases, key_expr=key_expr, keep=ARRIVAL,
    )
    good, _ = split_valid(rows, user_rules())
    return keep_latest(
        good, "users_to_table", "id", ARRIVAL, target=target, checkpoint_root=checkpoint_root, sink=sink,
        every=every, available_now=available_now)


def users_rejected(
    spark: SparkSession,
    topic: Topic,
    path: str,
    checkpoint_root: str,
    *,
    field_aliases: Mapping[str, str] | None = None,
    key_expr: Mapping[str, Column] | None = None,
    every: str | None = None,
    available_now: bool = False,
):
    """The user messages that ``users_to_table`` leaves out, appended with their reasons; a query beside it.

    ``runs.batches`` tells how many of each batch were good and how many rejected.
    """
    rows = decode(
        topic.stream(spark), CREATED_USER, field_aliases=field_aliases, key_expr=key_expr, keep=ARRIVAL)
    bad = tagged(rows, user_rules()).filter(F.size("reasons") > 0)
    return runs.start(
        bad, "users_rejected", append_sink(path), target=path, checkpoint_root=checkpoint_root,
        every=every, available_now=available_now)


def save_created_users(
    spark: SparkSession, checkpoint_root: str, location: str, *, database: str = USER_DATABASE, table: str = USER_TABLE,
) -> None:
    """The user table as it stands, as the catalog table users query, below ``location``.

    A table of that name that lies elsewhere is refused.
    """
    create_namespace(spark, database, location)
    replace_table(
        created_users(spark, checkpoint_root), f"{database}.{table}", CREATED_USER, f"{location}/{table}")


def users_to_documents(
    spark: SparkSession,
    topic: Topic,
    path: str,
    checkpoint_root: str,
    *,
    every: str = "5 seconds",
    available_now: bool = False,
):
    """User messages appended as they are, a batch every 5 seconds."""
    return runs.start(
        decode(topic.stream(spark), CREATED_USER), "users_to_documents", append_sink(path),
        target=path, checkpoint_root=checkpoint_root, every=every, available_now=available_now,
    )


def number_summary(spark: SparkSession, n: int = 10_000, factor: int = 5) -> DataFrame:
    """Count, mean and standard deviation of factor * 0, ..., factor * (n - 1)."""
    return numeric_stats(scaled(spark.range(n).toDF("number"), "number", factor), "number")


def news_rows(
    listing_pages: DataFrame,
    article_pages: DataFrame,
    work: str,
    *,
    layout: Layout = NEWS,
    strict: bool = False,
) -> DataFrame:
    """Listed articles with author, content and image from the pages they link to.

    ``listing_pages`` (page_id, html), ``article_pages`` (page_id, url, html);
    of pages with one url the greatest page_id counts. What is read from the
    HTML is stored below ``work`` first: each page is read once, and the join
    works on fields, not pages. ``missing`` and ``missing_told`` name elements
    that were not on the listing and on the article's page.
    """
    spark = listing_pages.sparkSession
    listed_articles(listing_pages, layout, strict=strict).write.mode("overwrite").parquet(
        f"{work}/listed")
    listed = spark.read.parquet(f"{work}/listed")
    told_articles(linked_pages(article_pages, listed), layout, keep=("page_id", "url")).withColumnsRenamed(
        {"page_id": "told_on", "missing": "missing_told"}
    ).write.mode("overwrite").parquet(f"{work}/told")
    rows = enrich(listed, spark.read.parquet(f"{work}/told"), newest_by=["told_on"], strict=strict)
    return checked(rows, "missing_told") if strict else rows


def linked_pages(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """The pages that a listed row links to, of each only the newest copy; no HTML is read for that."""
    newest = pages.groupBy(F.col("url").alias("_url")).agg(F.max("page_id").alias("_newest"))
    wanted = newest.join(listed.select(F.col("link").alias("_url")).distinct(), "_url", "left_semi")
    return pages.join(
        wanted, (F.col("url") == F.col("_url")) & F.col("page_id").eqNullSafe(F.col("_newest")), "left_semi")


def export_news(
    listing_pages: DataFrame, article_pages: DataFrame, work: str, csv: str, **options
) -> None:
    """The news table as CSV, in listing order."""
    rows = news_rows(listing_pages, article_pages, work, **options)
    export_csv(rows, csv, ARTICLE_FIELDS, order_by=["page_id", "pos"])
