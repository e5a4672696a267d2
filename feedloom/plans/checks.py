"""Every operator run over whole tables, next to the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feedloom.functions.markup import Attr, Text, read_all, read_fields, read_items
from feedloom.functions.text import py_strip, remove_literal
from feedloom.operators.articles import Layout, listed_articles, pages_without_container
from feedloom.operators.decode import decodable, decode
from feedloom.operators.drift import drift_report
from feedloom.operators.enrich import enrich
from feedloom.operators.flatten import complete, flatten_users
from feedloom.operators.latest import latest_per_key
from feedloom.operators.positions import store_numbered
from feedloom.operators.stats import numeric_stats, scaled
from feedloom.operators.validity import is_utf8, split_valid, tagged
from feedloom.plans import jobs
from feedloom.plans.jobs import Topic
from feedloom.schemas import (
    ARTICLE, CREATED_USER, CREATED_USER_FIELDS, KAFKA_CHECK_TOPIC, SINGLE_USER_TOPIC,
    USER_DATABASE, USER_FIELDS, USER_TABLE, USER_TOPIC, strings,
)
from feedloom.sinks.batches import append_sink, read_batches
from feedloom.sinks.csv import export_csv, read_csv_export
from feedloom.sources.pages import land_raw, read_html_files, store_bytes
from feedloom.sources.topics import as_messages, publish, read_topic
from feedloom.live import runs
from feedloom.live.state import keep_latest, latest_rows

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str


CHECKS: dict[str, Check] = {}


def check(sql: str):
    def register(query: Query) -> Query:
        CHECKS[query.__name__] = Check(query, sql)
        return query
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- numbers --------------------------------------------------------------

def rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@check("""
    SELECT count(n) AS count, round(avg(n * 5), 4) AS mean, round(stddev_samp(n * 5), 4) AS stddev
    FROM (SELECT unnest(range((SELECT max(l_orderkey) FROM lineitem))) AS n)
""")
def q_number_stats(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").agg(F.max("l_orderkey")).head()[0]
    return rounded(jobs.number_summary(spark, n))


@check("""
    SELECT count(value) AS count, round(avg(value * 5), 4) AS mean,
           round(stddev_samp(value * 5), 4) AS stddev
    FROM events
""")
def q_scaled_stats(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("value")
    return rounded(numeric_stats(scaled(events, "value", 5), "value"))


@check("""
    SELECT count(l_partkey) AS count, round(avg(l_partkey * 5), 4) AS mean,
           round(stddev_samp(l_partkey * 5), 4) AS stddev
    FROM lineitem
""")
def q_partkey_stats(spark, sf_dir):
    parts = table(spark, sf_dir, "lineitem").select("l_partkey")
    return rounded(numeric_stats(scaled(parts, "l_partkey", 5), "l_partkey"))


# --- messages -------------------------------------------------------------

EVENT_FIELDS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def event_messages(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    return as_messages(events.select(*EVENT_FIELDS), "events")


@check("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS user_id,
           event_type, CAST(value AS VARCHAR) AS value, props
    FROM events
""")
def q_envelope(spark, sf_dir):
    return decode(event_messages(spark, sf_dir), strings(EVENT_FIELDS))


@check("""
    SELECT 'customers' AS topic, TRUE AS no_key,
           CAST(json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_mktsegment',
                CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END) AS VARCHAR) AS value
    FROM customer
""")
def q_published(spark, sf_dir):
    segment = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("c_mktsegment")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", segment)
    messages = as_messages(customers, "customers")
    return messages.select(
        "topic", F.col("key").isNull().alias("no_key"), F.col("value").cast("string").alias("value")
    )


@check(f"""
    SELECT CASE event_type WHEN 'click' THEN '{USER_TOPIC}' ELSE '{SINGLE_USER_TOPIC}' END AS topic,
           CAST(event_id AS VARCHAR) AS event_id
    FROM events WHERE event_type IN ('click', 'view')
""")
def q_topic_routing(spark, sf_dir):
    path = runs.fresh_folder(spark, "topics")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    routes = {USER_TOPIC: F.col("event_type") == "click",
              SINGLE_USER_TOPIC: F.col("event_type") == "view",
              KAFKA_CHECK_TOPIC: ~F.col("event_type").isin("click", "view")}
    for topic, condition in routes.items():
        publish(events.filter(condition), topic, path=path)
    messages = read_topic(spark, [USER_TOPIC, SINGLE_USER_TOPIC], path=path, stream=False)
    return decode(messages, strings(["event_id"]), keep=["topic"])


DRIFTED = ["event_id", "at", "user", "event_type", "value", "props"]
DRIFTED_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS event_id, {at} AS at, {user} AS user, event_type, CAST(value AS VARCHAR) AS value, props
    FROM events
"""


@check(DRIFTED_SQL.format(at="CAST(NULL AS VARCHAR)", user="CAST(NULL AS VARCHAR)"))
def q_drift(spark, sf_dir):
    return decode(event_messages(spark, sf_dir), strings(DRIFTED))


@check(DRIFTED_SQL.format(at="CAST(ts AS VARCHAR)", user="CAST(user_id AS VARCHAR)"))
def q_field_alias(spark, sf_dir):
    return decode(event_messages(spark, sf_dir), strings(DRIFTED), field_aliases={"user_id": "user", "ts": "at"})


@check("""
    SELECT event_id AS "offset", CASE WHEN event_id % 9 <> 4 THEN CAST(user_id AS VARCHAR) END AS user_id,
           CASE WHEN event_id % 9 <> 4 THEN event_type END AS event_type,
           CASE WHEN event_id % 9 = 4 THEN 'no UTF-8' ELSE '' END AS reasons,
           CASE WHEN event_id % 9 = 4 THEN event_type || chr(65533) ELSE event_type END AS repaired
    FROM events
""")
def q_not_utf8(spark, sf_dir):
    # Every ninth message has a byte in its text that no UTF-8 has.
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    text = F.to_json(F.struct("user_id", F.concat("event_type", F.lit("~")).alias("event_type")))
    begin, end = (F.encode(F.substring_index(text, "~", n), "UTF-8") for n in (1, -1))
    broken = F.when(F.col("event_id") % 9 == 4, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    messages = events.select(F.col("event_id").alias("offset"), F.concat(begin, broken, end).alias("value"))
    schema = strings(["user_id", "event_type"])
    good, bad = split_valid(messages, {"no UTF-8": is_utf8(F.col("value"))})
    rows = decode(good, schema, keep=["offset"]).withColumn("reasons", F.lit("")).unionByName(
        bad.select("offset", F.array_join("reasons", ",").alias("reasons")), allowMissingColumns=True)
    repaired = decode(messages, schema, keep=["offset"], repair_utf8=True).select(
        "offset", F.col("event_type").alias("repaired"))
    return rows.join(repaired, "offset")


def damaged_messages(spark, sf_dir):
    """The events as messages at offset event_id; every tenth is cut short, every 25th is empty."""
    events = table(spark, sf_dir, "events")
    text = F.to_json(F.struct("user_id", "event_type"))
    text = F.when(F.col("event_id") % 10 == 0, F.substr(text, F.lit(1), F.length(text) - 3)).when(
        F.col("event_id") % 25 == 1, F.lit("{}")).otherwise(text)
    return events.select(F.col("event_id").alias("offset"), F.encode(text, "UTF-8").alias("value"))


@check("""
    SELECT event_id AS "offset",
           CASE WHEN event_id % 10 <> 0 AND event_id % 25 <> 1 THEN CAST(user_id AS VARCHAR) END
               AS user_id,
           CASE WHEN event_id % 10 <> 0 AND event_id % 25 <> 1 THEN event_type END AS event_type
    FROM events
""")
def q_malformed(spark, sf_dir):
    messages = damaged_messages(spark, sf_dir)
    return decode(messages, strings(["user_id", "event_type"]), keep=["offset"])


@check("""
    SELECT event_id AS "offset", 'undecodable' AS reasons
    FROM events WHERE event_id % 10 = 0 OR event_id % 25 = 1
""")
def q_quarantine(spark, sf_dir):
    schema = strings(["user_id", "event_type"])
    rows = decode(damaged_messages(spark, sf_dir), schema, keep=["offset"], corrupt_col="corrupt")
    _, bad = split_valid(rows, {"undecodable": decodable(schema, "corrupt")})
    return bad.select("offset", F.array_join("reasons", ",").alias("reasons"))


@check("SELECT event_id, (props::JSON)->>'k' AS k FROM events")
def q_props(spark, sf_dir):
    parsed = F.from_json("props", strings(["k"]))
    return table(spark, sf_dir, "events").select("event_id", parsed.alias("data")).select(
        "event_id", "data.*")


@check("SELECT event_id, event_type, user_id FROM events ORDER BY event_id LIMIT 20")
def q_preview(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "user_id").orderBy(
        "event_id").limit(20)


# --- users ----------------------------------------------------------------

def user_payloads(spark, sf_dir, null_fields: bool = True):
    """Customers as API responses; every seventh has a null city, or with
    ``null_fields=False`` none at all."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    c = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com"))

    def one(name, value):
        return F.struct(value.alias(name))

    user = F.struct(
        F.when(F.col("c_custkey") % 2 == 0, "female").otherwise("male").alias("gender"),
        F.struct(F.substring_index("c_name", "#", 1).alias("first"),
                 F.substring_index("c_name", "#", -1).alias("last")).alias("name"),
        F.struct(
            F.struct(F.col("c_custkey").alias("number"), F.col("c_mktsegment").alias("name"))
            .alias("street"),
            F.when(F.col("c_custkey") % 7 != 0, F.col("n_name")).alias("city"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("country"),
            (F.col("c_custkey") + 10000).alias("postcode"),
        ).alias("location"),
        email.alias("email"),
        one("username", F.lower("c_mktsegment")).alias("login"),
        one("date", F.concat(F.lit("1990-01-01T00:00:00Z+"), F.col("c_custkey"))).alias("dob"),
        one("date", F.concat(F.lit("2020-01-01T00:00:00Z+"), F.col("c_custkey"))).alias("registered"),
        F.concat(F.lit("555-"), F.col("c_custkey")).alias("phone"),
        one("medium", F.concat(F.lit("https://example.com/"), F.col("c_custkey"), F.lit(".jpg")))
        .alias("picture"),
    )
    options = {"ignoreNullFields": "false" if null_fields else "true"}
    return c.select("c_custkey", F.to_json(one("results", F.array(user)), options).alias("raw"))


USERS_SQL = """
    SELECT c_custkey, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
           CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           c_custkey || ' ' || c_mktsegment || ', '
               || CASE WHEN c_custkey % 7 <> 0 THEN n_name ELSE 'None' END
               || ' ' || r_name || ' ' || n_name AS address,
           CAST(c_custkey + 10000 AS VARCHAR) AS postcode,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email,
           lower(c_mktsegment) AS username,
           '1990-01-01T00:00:00Z+' || c_custkey AS dob,
           '2020-01-01T00:00:00Z+' || c_custkey AS registered_date,
           '555-' || c_custkey AS phone,
           'https://example.com/' || c_custkey || '.jpg' AS picture
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
# A UUID made of the MD5 of the e-mail address.
KEY_SQL = "regexp_replace(md5(email), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5')"


def key_of_email():
    return F.regexp_replace(
        F.md5("email"), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


@check(f"SELECT {', '.join(USER_FIELDS)} FROM ({USERS_SQL})")
def q_flatten(spark, sf_dir):
    return flatten_users(user_payloads(spark, sf_dir)).select(*USER_FIELDS)


@check(f"SELECT c_custkey, address, postcode FROM ({USERS_SQL}) WHERE c_custkey % 7 <> 0")
def q_reject(spark, sf_dir):
    users = flatten_users(user_payloads(spark, sf_dir, null_fields=False))
    good, _ = split_valid(users, {"missing path": complete()})
    return good.select("c_custkey", "address", "postcode")


@check("""
    SELECT c_custkey, 'location.city' AS missing, 'missing path' AS reasons
    FROM customer WHERE c_custkey % 7 = 0
""")
def q_rejected(spark, sf_dir):
    users = flatten_users(user_payloads(spark, sf_dir, null_fields=False))
    _, bad = split_valid(users, {"missing path": complete()})
    return bad.select("c_custkey", F.array_join("missing", ",").alias("missing"),
                      F.array_join("reasons", ",").alias("reasons"))


def published_users(spark, sf_dir, folder) -> Topic:
    topic = Topic(path=f"{folder}/topics")
    jobs.publish_users(user_payloads(spark, sf_dir), topic)
    return topic


@check(f"""
    SELECT {KEY_SQL} AS id, first_name, last_name, gender, address, postcode AS post_code, email,
           username, registered_date, phone, picture
    FROM ({USERS_SQL})
""")
def q_created_users(spark, sf_dir):
    folder = runs.fresh_folder(spark, "created-users")
    runs.run_bounded(jobs.users_to_table(
        spark, published_users(spark, sf_dir, folder), f"{folder}/checkpoints",
        field_aliases={"postcode": "post_code"}, key_expr={"id": key_of_email()}, available_now=True), None)
    database = f"{USER_DATABASE}_{uuid.uuid4().hex}"
    jobs.save_created_users(spark, f"{folder}/checkpoints", f"{folder}/table", database=database)
    return spark.table(f"{database}.{USER_TABLE}").select(*CREATED_USER_FIELDS)


@check(f"""
    SELECT CAST(NULL AS VARCHAR) AS id, email, CAST(NULL AS VARCHAR) AS post_code,
           'no id,id is no UUID' AS reasons
    FROM ({USERS_SQL})
""")
def q_users_without_key(spark, sf_dir):
    folder = runs.fresh_folder(spark, "users-without-key")
    runs.run_bounded(jobs.users_rejected(
        spark, published_users(spark, sf_dir, folder), f"{folder}/users", f"{folder}/checkpoints", available_now=True), None)
    schema = f"{CREATED_USER.simpleString()[7:-1].replace(':', ' ')}, reasons array<string>"
    return read_batches(spark, f"{folder}/users", schema, "rejected").select(
        "id", "email", "post_code", F.array_join("reasons", ",").alias("reasons"))


# The lines of responses as a reader of lines sees them; every seventh lacks its city.
@check(f"""
    SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN email END AS email,
           CASE WHEN c_custkey % 7 <> 0 THEN address END AS address,
           CASE WHEN c_custkey % 7 <> 0 THEN postcode END AS postcode,
           CASE WHEN c_custkey % 7 = 0 THEN 'location.city' END AS missing,
           CASE WHEN c_custkey <= (SELECT max(c_custkey) FROM customer) // 2 THEN 0 ELSE 1 END AS batch
    FROM ({USERS_SQL})
""")
def q_responses_published(spark, sf_dir):
    folder = runs.fresh_folder(spark, "responses")
    topic = Topic(path=f"{folder}/topics")
    payloads = user_payloads(spark, sf_dir, null_fields=False)
    half = payloads.agg(F.max("c_custkey")).head()[0] // 2
    for part in (F.col("c_custkey") <= half, F.col("c_custkey") > half):
        # What arrives, and a run on the checkpoint of the one before.
        payloads.filter(part).select("raw").write.mode("append").text(f"{folder}/arrived")
        runs.run_bounded(jobs.publish_responses(
            spark, f"{folder}/arrived", topic, f"{folder}/checkpoints", rejected=f"{folder}/rejected", available_now=True), None)
    good = decode(read_topic(spark, USER_TOPIC, path=topic.path, stream=False, with_batch=True), strings(USER_FIELDS), keep=["batch_id"]).select(
        F.split_part("phone", F.lit("-"), F.lit(2)).cast("long").alias("c_custkey"), "email", "address", "postcode",
        F.lit(None).cast("string").alias("missing"), F.col("batch_id").alias("batch"))
    bad = spark.read.parquet(f"{folder}/rejected")
    return good.unionByName(bad.select(
        F.get_json_object("raw", "$.results[0].name.last").cast("long").alias("c_custkey"),
        F.array_join("missing", ",").alias("missing"), F.col("batch_id").cast("long").alias("batch")), allowMissingColumns=True)


@check(f"""
    SELECT * FROM (VALUES {", ".join(f"('{f}', {f != 'post_code' and f != 'id'}, {f not in ('postcode', 'dob')})"
                                     for f in sorted({*USER_FIELDS, *CREATED_USER_FIELDS}))}) f(field, in_messages, in_contract),
        LATERAL (SELECT CASE WHEN in_messages THEN count(*) ELSE 0 END AS messages,
                        CASE WHEN in_messages THEN CASE WHEN field = 'postcode' THEN 'BIGINT' ELSE 'STRING' END END AS type
                 FROM customer)
""")
def q_drift_report(spark, sf_dir):
    topic = published_users(spark, sf_dir, runs.fresh_folder(spark, "drift"))
    messages = read_topic(spark, topic.name, path=topic.path, stream=False)
    return drift_report(messages, CREATED_USER).drop("nulls")


@check(f"""
    SELECT CAST(NULL AS VARCHAR) AS id, first_name, last_name, gender, address,
           CAST(NULL AS VARCHAR) AS post_code, email, username, registered_date, phone, picture
    FROM ({USERS_SQL})
""")
def q_user_documents(spark, sf_dir):
    folder = runs.fresh_folder(spark, "user-documents")
    query = jobs.users_to_documents(
        spark, published_users(spark, sf_dir, folder), f"{folder}/documents",
        f"{folder}/checkpoints", available_now=True,
    )
    runs.run_bounded(query, None)
    return read_batches(spark, f"{folder}/documents", CREATED_USER).select(*CREATED_USER_FIELDS)


# --- targets --------------------------------------------------------------

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
LATEST_BY = ["ts", "event_id"]


def event_stream(spark, folder, **options):
    """The events of the topic in ``folder`` as typed rows."""
    messages = read_topic(spark, "events", path=f"{folder}/topics", options=options)
    return decode(messages, strings(EVENT_FIELDS)).select(
        *[F.col(f.split()[0]).cast(f.split()[1]) for f in EVENT_SCHEMA.split(", ")])


def replayed_events(spark, sf_dir, folder, run, times: int = 1) -> None:
    """Publish the events, then stream them in about four micro-batches with ``run`` (stream).

    Further ``times`` go on with the same checkpoint.
    """
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    share = -(-events.count() // 4)
    publish(events, "events", path=f"{folder}/topics", options={"maxRecordsPerFile": str(share)})
    size = spark.read.format("binaryFile").load(f"{folder}/topics").agg(F.sum("length")).head()[0]
    for _ in range(times):
        runs.run_bounded(run(event_stream(spark, folder, maxBytesPerTrigger=str(-(-size // 4)))), None)


def appending(folder):
    return lambda rows: runs.start(
        rows, "events", append_sink(f"{folder}/target"), target=folder, checkpoint_root=f"{folder}/checkpoints", available_now=True)


def keeping_latest(folder):
    return lambda rows: keep_latest(
        rows, "latest", "user_id", LATEST_BY, target="state", checkpoint_root=f"{folder}/checkpoints", available_now=True)


LATEST_SQL = """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
        FROM events) WHERE place = 1
"""


@check(LATEST_SQL)
def q_latest(spark, sf_dir):
    return latest_per_key(table(spark, sf_dir, "events"), "user_id", LATEST_BY)


def kept_events(spark, folder):
    return latest_rows(spark, f"{folder}/checkpoints", "latest", EVENT_SCHEMA, "user_id", LATEST_BY)


@check(LATEST_SQL)
def q_upsert_latest(spark, sf_dir):
    folder = runs.fresh_folder(spark, "upsert")
    replayed_events(spark, sf_dir, folder, keeping_latest(folder))
    return kept_events(spark, folder)


@check(LATEST_SQL)
def q_upsert_compacted(spark, sf_dir):
    # Stopped after the odd events; the next start goes on with the state that was kept, with the even ones and some odd again.
    folder = runs.fresh_folder(spark, "upsert-again")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    for part in (F.col("event_id") % 2 == 1, (F.col("event_id") % 2 == 0) | (F.col("event_id") % 3 == 0)):
        publish(events.filter(part), "events", path=f"{folder}/topics")
        runs.run_bounded(keeping_latest(folder)(event_stream(spark, folder)), None)
    return kept_events(spark, folder)


@check("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stream_append(spark, sf_dir):
    folder = runs.fresh_folder(spark, "append")
    replayed_events(spark, sf_dir, folder, appending(folder), times=2)
    return read_batches(spark, f"{folder}/target", EVENT_SCHEMA).select(*EVENT_FIELDS)


@check("SELECT user_id, event_type FROM events")
def q_subset(spark, sf_dir):
    folder = runs.fresh_folder(spark, "subset")
    replayed_events(spark, sf_dir, folder, appending(folder))
    return read_batches(spark, f"{folder}/target", EVENT_SCHEMA).select("user_id", "event_type")


def quarters(spark, sf_dir, folder) -> None:
    """Publish the events in four files, the first quarter of the ids first."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    for quarter in range(4):
        publish(events.filter(F.col("event_id") % 4 == quarter).coalesce(1), "events", path=f"{folder}/topics")


@check("""
    SELECT event_id % 4 AS batch_id, count(*) FILTER (WHERE event_type <> 'click' AND value > 10) AS good,
           count(*) FILTER (WHERE event_type = 'click' OR value <= 10) AS rejected
    FROM events GROUP BY ALL
""")
def q_batch_counts(spark, sf_dir):
    folder = runs.fresh_folder(spark, "counts")
    quarters(spark, sf_dir, folder)
    rows = tagged(event_stream(spark, folder, maxFilesPerTrigger="1"), {
        "no click": F.col("event_type") != "click", "large": F.col("value") > 10})
    query = appending(folder)(rows)
    runs.run_bounded(query, None)
    told = runs.batches(spark, query)
    # What was written must be what was counted.
    kept = read_batches(spark, f"{folder}/target", EVENT_SCHEMA).groupBy("batch_id").agg(F.count("*").alias("good"))
    return told.join(kept, "batch_id").filter(F.col("counts")["good"] == F.col("good")).select(
        "batch_id", "good", F.col("counts")["rejected"].alias("rejected"))


@check("""
    SELECT event_id % 4 AS batch_id, count(*) AS rows, TRUE AS in_own_interval FROM events GROUP BY ALL
""")
def q_interval_batches(spark, sf_dir):
    folder = runs.fresh_folder(spark, "interval")
    quarters(spark, sf_dir, folder)
    query = runs.start(
        event_stream(spark, folder, maxFilesPerTrigger="1"), "events", append_sink(f"{folder}/target"),
        target=folder, checkpoint_root=f"{folder}/checkpoints", every="2 seconds")
    runs.run_batches(query, 3)
    # A batch starts when an interval of the clock does, or late in it if the one before took longer.
    ticks = runs.batches(spark, query).withColumn("tick", F.floor(F.unix_millis("started") / 2000))
    return ticks.select("batch_id", "rows", (F.count("*").over(Window.partitionBy("tick")) == 1).alias("in_own_interval"))


@check("""
    SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // (SELECT (count(*) + 4) // 5 FROM events) AS batch_id
    FROM events
""")
def q_paced(spark, sf_dir):
    folder = runs.fresh_folder(spark, "paced")
    events = store_numbered(table(spark, sf_dir, "events"), LATEST_BY, f"{folder}/numbered")
    share = -(-events.count() // 5)
    topic = Topic("events", path=f"{folder}/topics")
    for last in (2, 4):  # the second start goes on where the first was stopped
        query = jobs.publish_paced(events, topic, f"{folder}/checkpoints", per_batch=share)
        runs.run_batches(query, last)
    return decode(read_topic(spark, "events", path=topic.path, stream=False, with_batch=True), strings(["event_id"]), keep=["batch_id"]).select(
        F.col("event_id").cast("long").alias("event_id"), "batch_id")


@check("SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_roundtrip(spark, sf_dir):
    path = f"{runs.fresh_folder(spark, 'csv')}/documents"
    export_csv(table(spark, sf_dir, "documents"), path, ["doc_id", "text", "lang", "source", "n_chars"])
    return read_csv_export(spark, path, "doc_id long, text string, lang string, source string, n_chars long")


@check("SELECT page_id, url, html FROM pages")
def q_landing(spark, sf_dir):
    path = f"{runs.fresh_folder(spark, 'landing')}/pages"
    land_raw(table(spark, sf_dir, "pages"), path)
    return spark.read.parquet(path)


@check("""
    SELECT doc_id, source, text || ' again' AS text FROM documents WHERE source = (SELECT min(source) FROM documents)
    UNION ALL
    SELECT doc_id, source, text FROM documents WHERE source IS DISTINCT FROM (SELECT min(source) FROM documents)
""")
def q_landing_by_source(spark, sf_dir):
    path = f"{runs.fresh_folder(spark, 'landing-by-source')}/documents"
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    first = docs.agg(F.min("source")).head()[0]
    one, others = docs.filter(F.col("source") == first), docs.filter(~F.col("source").eqNullSafe(first))
    # The first source is fetched twice, and the others land between.
    for landing in (one, others, one.withColumn("text", F.concat("text", F.lit(" again")))):
        land_raw(landing, path, by="source")
    return spark.read.schema("doc_id long, text string, source string").parquet(path).select("doc_id", "source", "text")


# --- pages ----------------------------------------------------------------

CHARSETS = ["windows-1252", "utf-8", "iso-8859-1", "utf-16", "koi8-r"]


@check("""
    SELECT page_id, ['windows-1252', 'utf-8', 'iso-8859-1', 'utf-16', 'koi8-r'][page_id % 5 + 1] AS charset,
           CASE WHEN page_id % 5 = 4 THEN regexp_replace(replace(html, 'charset="utf-8"', 'charset="utf-8"'), '[^\x00-\x7F]', 'ж', 'g')
                WHEN page_id % 5 = 3 THEN html
                ELSE replace(html, 'charset="utf-8"', 'charset="' ||
                    ['windows-1252', 'utf-8', 'iso-8859-1'][page_id % 5 + 1] || '"') END AS html
    FROM pages
""")
def q_page_files(spark, sf_dir):
    folder = runs.fresh_folder(spark, "page-files")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.element_at(F.array(*map(F.lit, CHARSETS)), (F.col("page_id") % 5 + 1).cast("int")).alias("charset"), "html")
    # Three charsets are what a page declares, one is seen by its mark, and of the last only the response's header tells.
    said = F.when(F.col("charset") == "koi8-r", F.regexp_replace("html", "[^\\x00-\\x7F]", "ж")).when(
        F.col("charset") == "utf-16", F.col("html")).otherwise(
        F.replace("html", F.lit('charset="utf-8"'), F.concat(F.lit('charset="'), "charset", F.lit('"'))))

    def encode(batches):
        import pyarrow as pa

        for batch in batches:
            name, charset, html = batch.columns
            content = pa.array((text.as_py().encode(of) for text, of in zip(html, charset.to_pylist())), pa.binary())
            yield pa.RecordBatch.from_arrays([name, content], ["name", "content"])

    files = pages.select(F.format_string("%d.html", "page_id").alias("name"), "charset", said.alias("html")).mapInArrow(
        encode, "name string, content binary")
    store_bytes(files, f"{folder}/pages").write.parquet(f"{folder}/listed")
    header = read_html_files(spark, f"{folder}/pages", glob="*.html").select("url").filter(page_of("url") % 5 == 4).withColumn(
        "charset", F.lit("KOI8-R"))
    return read_html_files(spark, f"{folder}/pages", glob="*.html", charsets=header).select(
        page_of("url").alias("page_id"), "charset", "html")


def page_of(url):
    return F.regexp_extract(url, r"(\d+)\.html$", 1).cast("long")


AD = ("div", "ad")
# The first element of a name, as RE2 sees it; the test pages nest none of these.
ARTICLE_SQL = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"


def text_sql(source: str) -> str:
    """What ``Text`` reads, for a column or expression with the inner source.

    A tag ends an entity as a semicolon does, which must be seen before the tags go.
    """
    steps = f"regexp_replace({source}, '&(amp|lt|gt|quot|copy|middot)(<|$)', '&\\1;\\2', 'g')"
    for pattern, new in [
        ("<!--.*?-->|<script.*?</script>|<style.*?</style>", "<!---->"),
        (">[ \\t\\f\\r]*\\n[ \\t\\n\\f\\r]*<", ">\n<"), (">[ \\t\\f\\r]+<", "> <"), ("<[^<>]*>", ""),
    ]:
        steps = f"regexp_replace({steps}, '(?s){pattern}', '{new}', 'g')"
    for entity, char in [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"),
                         ("&gt;", ">"), ("&#39;", "''"), ("&amp;", "&")]:
        steps = f"replace({steps}, '{entity}', '{char}')"
    return f"trim({steps}, ' ' || chr(9) || chr(10) || chr(12) || chr(13))"


@check("""
    SELECT page_id, unnest(range(len(items))) AS pos, unnest(items) AS item FROM (
        SELECT page_id, regexp_extract_all(
            regexp_extract(html, '(?s)<div class="ad">(.*)', 1),
            '(?s)<article>(.*?)</article>', 1) AS items
        FROM pages)
""")
def q_articles(spark, sf_dir):
    items = read_items(table(spark, sf_dir, "pages").drop("url"), "html", AD, "article")
    return items.select("page_id", F.posexplode("items").alias("pos", "item")).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "item")


@check(f"""
    SELECT page_id, {text_sql("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS title FROM pages
""")
def q_title(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return read_fields(pages, "html", {"title": Text("h1")}).select("page_id", "title")


@check(f"SELECT page_id, {text_sql(ARTICLE_SQL)} AS text FROM pages")
def q_article_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return read_fields(pages, "html", {"text": Text("article")}).select("page_id", "text")


@check("""
    SELECT page_id, replace(regexp_extract(html, '<a href="([^"]*)"', 1), '&amp;', '&') AS link
    FROM pages
""")
def q_first_link(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return read_fields(pages, "html", {"link": Attr("href", (("a", None),))}).select(
        "page_id", "link")


@check("""
    SELECT page_id, unnest(range(len(links))) AS pos, replace(unnest(links), '&amp;', '&') AS link
    FROM (SELECT page_id, regexp_extract_all(
        regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>', '', 'g'), '<a [^>]*?href="([^"]*)"', 1) AS links
        FROM pages)
""")
def q_links(spark, sf_dir):
    # Links in a comment and in a script are none; every third page goes to the parser.
    html = F.concat("html", F.lit("""<!-- <a href="/no"> --><script>x = '<a href="/no">';</script>"""),
                    F.when(F.col("page_id") % 3 == 0, "<noscript></noscript>").otherwise(""))
    pages = table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    return read_all(pages, "html", "a", "href").select("page_id", F.posexplode("values").alias("pos", "link")) \
        .select("page_id", F.col("pos").cast("long").alias("pos"), "link")


@check("""
    SELECT page_id,
           replace(regexp_extract(html, '(?s)<nav>.*?<li>.*?<li>.*?<a href="([^"]*)"', 1),
                   '&amp;', '&') AS link
    FROM pages
""")
def q_next_attr(spark, sf_dir):
    steps = (("nav", None), ("li", None), ("li", None), ("a", None))
    pages = table(spark, sf_dir, "pages")
    return read_fields(pages, "html", {"link": Attr("href", steps)}).select("page_id", "link")


@check("""
    SELECT page_id, concat_ws(',', CASE WHEN page_id % 3 = 0 THEN 'title' END, 'excerpt',
                              CASE WHEN page_id % 2 = 0 THEN 'image' END) AS missing, TRUE AS no_container
    FROM pages WHERE page_id % 5 <> 0
""")
def q_missing(spark, sf_dir):
    # Every third page loses its title, every second gets an image, every fifth the container.
    html = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("html", "</?h1>", "")).otherwise(F.col("html"))
    html = F.concat(
        html, F.when(F.col("page_id") % 2 == 1, "<figure><img src='i.png'></figure>").otherwise(""),
        F.when(F.col("page_id") % 5 == 0, "<div class='latest-news-timeline-section'></div>").otherwise(""))
    pages = table(spark, sf_dir, "pages").withColumn("html", html)
    layout = Layout(("div", "latest-news-timeline-section"), "article", {}, {})
    without = pages_without_container(pages, layout).select("page_id", "html")
    fields = {"title": Text("h1"), "excerpt": Text("p", "post-excerpt"),
              "image": Attr("src", (("figure", None), ("img", None)))}
    return read_fields(without, "html", fields).select(
        "page_id", F.array_join("missing", ",").alias("missing"), F.lit(True).alias("no_container"))


@check("SELECT p_partkey, trim(replace(p_name, 'old', '')) AS p_name FROM part")
def q_byline(spark, sf_dir):
    name = py_strip(remove_literal(F.col("p_name"), "old"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("p_name"))


@check(f"""
    SELECT page_id, 0 AS pos, url AS link, max({text_sql(ARTICLE_SQL)}) OVER (PARTITION BY url) AS text,
           TRUE AS found
    FROM pages
""")
def q_enrich(spark, sf_dir):
    work = runs.fresh_folder(spark, "enrich")
    pages = table(spark, sf_dir, "pages")
    read_fields(pages, "html", {"text": Text("article")}).select("page_id", "url", "text") \
        .write.parquet(work)
    told = spark.read.parquet(work)
    listing = told.select("page_id", F.lit(0).alias("pos"), F.col("url").alias("link"))
    return enrich(listing, told.select("url", "text"))


def news_site(spark, sf_dir):
    """The pages retold as a news site: (listing pages, article pages). A story is the whole page
    with the marks of a story around its article.

    A page lists itself and, beyond the container's end, the front page, which
    is thus on a link of half of all rows; pages that are told twice differ.
    """
    pages = table(spark, sf_dir, "pages")
    first = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    url = F.replace("url", F.lit("&"), F.lit("&amp;"))

    def row(link, title):
        return F.concat(
            F.lit('<article id="x"><a class="post-link" href="'), link, F.lit('">more</a>'),
            F.lit('<h1 class="big post-title">\n'), title, F.lit("</h1>"),
            F.lit('<p class="post-excerpt">On <b>'), F.col("page_id"), F.lit("</b></p>"),
            F.lit("<span class='post-date'> day "), F.col("page_id"), F.lit(" </span></article>"))

    listing = pages.select("page_id", F.concat(
        F.lit("<html><article>not yet</article><div class='latest-news-timeline-section'>"),
        row(url, first), F.lit("</div>"), row(F.lit("/front"), F.lit("Front &amp; last")),
        F.lit("</html>"),
    ).alias("html"))

    def story(author, begin, end):
        """The whole page, its article between the marks of a story."""
        opened = F.concat(
            F.lit("<!-- <span class='post-author'>no</span> --><span class='post-author'>By "), F.lit(author),
            F.lit(f"</span><div class='post-content'>{begin}"))
        closed = F.concat(
            F.lit(f"{end}</div><img src='no.png'><div class='post-image-wrapper'></div><figure><img src='/"),
            F.col("page_id"), F.lit(".png'></figure>"))
        return F.replace(F.replace("html", F.lit("<article>"), opened), F.lit("</article>"), closed)

    told = pages.select("page_id", "url", story("Byron", "", "").alias("html"))
    front = pages.select(
        "page_id", F.lit("/front").alias("url"), story("Jane", "<div>", "</div> nested").alias("html"))
    return listing, told.unionByName(front)


TITLE_SQL = text_sql("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")
NEWS_SQL = f"""
    SELECT page_id, 0 AS pos, {TITLE_SQL} AS title, 'On ' || page_id AS excerpt,
           'day ' || page_id AS date, url AS link, ' ron' AS author,
           arg_max({text_sql(ARTICLE_SQL)}, page_id) OVER (PARTITION BY url) AS content,
           '/' || max(page_id) OVER (PARTITION BY url) || '.png' AS image
    FROM pages
    UNION ALL
    SELECT page_id, 1, 'Front & last', 'On ' || page_id, 'day ' || page_id, '/front', ' Jane',
           (SELECT {text_sql(f"('<div>' || {ARTICLE_SQL} || '</div> nested')")} FROM pages ORDER BY page_id DESC LIMIT 1),
           (SELECT '/' || max(page_id) || '.png' FROM pages)
    FROM pages
"""


@check(NEWS_SQL)
def q_news(spark, sf_dir):
    listing, told = news_site(spark, sf_dir)
    rows = jobs.news_rows(listing, told, runs.fresh_folder(spark, "news"))
    return rows.select("page_id", "pos", *ARTICLE.fieldNames())


@check(f"SELECT title, excerpt, date, link, author, content, image FROM ({NEWS_SQL})")
def q_news_csv(spark, sf_dir):
    folder = runs.fresh_folder(spark, "news-csv")
    listing, told = news_site(spark, sf_dir)
    jobs.export_news(listing, told, f"{folder}/work", f"{folder}/csv", strict=True)
    return read_csv_export(spark, f"{folder}/csv", ARTICLE)


@check(f"""
    SELECT page_id, pos, title, link FROM ({NEWS_SQL})
""")
def q_listing(spark, sf_dir):
    listing, _ = news_site(spark, sf_dir)
    return listed_articles(listing).select("page_id", "pos", "title", "link")
