"""Topics, sinks, state, progress and replay."""

import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from feedloom.operators.decode import decode
from feedloom.plans import jobs
from feedloom.plans.jobs import Topic
from feedloom.schemas import ENVELOPE, strings
from feedloom.sinks.batches import append_sink, read_batches
from feedloom.sources.topics import publish, read_topic
from feedloom.live import runs
from feedloom.live.state import keep_latest, latest_rows
from feedloom.operators.positions import store_numbered
from feedloom.operators.validity import tagged

SCHEMA = strings(["k", "v"])


def publish_rows(spark, work, rows, topic="t"):
    publish(spark.createDataFrame(rows, SCHEMA).coalesce(1), topic, path=f"{work}/topics")


def append_run(spark, work, target="target", query="append", checkpoints="checkpoints"):
    stream = decode(read_topic(spark, "t", path=f"{work}/topics",
                               options={"maxFilesPerTrigger": "1"}), SCHEMA)
    return runs.start(
        stream, query, append_sink(f"{work}/{target}"), target=f"{work}/{target}",
        checkpoint_root=f"{work}/{checkpoints}", available_now=True,
    )


def appended(spark, work, target="target"):
    return sorted((r.k, r.v) for r in read_batches(spark, f"{work}/{target}", SCHEMA).collect())


def test_topics_are_kept_apart(spark, work):
    for topic in ["a", "b", "c"]:
        publish_rows(spark, work, [(topic, "1")], topic)
    messages = read_topic(spark, ["a", "c"], path=f"{work}/topics", stream=False)
    assert messages.schema.fieldNames() == ENVELOPE.fieldNames()
    assert sorted((r.topic, r.key) for r in messages.collect()) == [("a", None), ("c", None)]


def test_restart_adds_only_what_is_new(spark, work):
    publish_rows(spark, work, [("a", "1")])
    publish_rows(spark, work, [("b", "2")])
    assert runs.run_bounded(append_run(spark, work))
    assert appended(spark, work) == [("a", "1"), ("b", "2")]
    assert runs.run_bounded(append_run(spark, work))
    assert appended(spark, work) == [("a", "1"), ("b", "2")]
    publish_rows(spark, work, [("c", None)])
    runs.run_bounded(append_run(spark, work))
    assert len(appended(spark, work)) == 3
    batches = read_batches(spark, f"{work}/target", SCHEMA).groupBy("batch_id").count().collect()
    assert sorted(r.batch_id for r in batches) == [0, 1, 2]


def test_replayed_batch_is_replaced(spark, work):
    sink = append_sink(f"{work}/target")
    batch = spark.createDataFrame([("a", "1")], SCHEMA)
    for _ in range(2):
        sink(batch, 0, "run")
    assert appended(spark, work) == [("a", "1")]


def test_new_checkpoint_keeps_earlier_batches(spark, work):
    publish_rows(spark, work, [("a", "1")])
    runs.run_bounded(append_run(spark, work))
    runs.run_bounded(append_run(spark, work, checkpoints="others"))
    assert appended(spark, work) == [("a", "1"), ("a", "1")]


def test_foreign_checkpoint_is_refused(spark, work):
    publish_rows(spark, work, [("a", "1")])
    runs.run_bounded(append_run(spark, work))
    with pytest.raises(ValueError, match="belongs to query"):
        append_run(spark, work, target="other")


def test_two_sinks_both_complete(spark, work):
    publish_rows(spark, work, [("a", "1"), ("b", "2")])
    first = append_run(spark, work, "one", "one")
    second = append_run(spark, work, "two", "two")
    runs.run_bounded(first), runs.run_bounded(second)
    assert appended(spark, work, "one") == appended(spark, work, "two") == [("a", "1"), ("b", "2")]


def test_rejected_rows_are_kept(spark, work):
    sink = append_sink(f"{work}/target", {"no v": F.col("v").isNotNull()})
    sink(spark.createDataFrame([("a", "1"), ("b", None)], SCHEMA), 0, "run")
    assert appended(spark, work) == [("a", "1")]
    rejected = read_batches(spark, f"{work}/target", "k string, v string, reasons array<string>",
                            "rejected").collect()
    assert [(r.k, r.reasons) for r in rejected] == [("b", ["no v"])]


def test_bounded_run_is_stopped(spark, work):
    publish_rows(spark, work, [("a", "1")])
    stream = decode(read_topic(spark, "t", path=f"{work}/topics"), SCHEMA)
    query = runs.start(stream, "paced", append_sink(f"{work}/target"), target=f"{work}/target",
                       checkpoint_root=f"{work}/checkpoints", every="1 seconds")
    started = time.time()
    assert not runs.run_bounded(query, 8)
    assert 7 < time.time() - started < 60 and not query.isActive
    assert appended(spark, work) == [("a", "1")]


def test_failing_sink_is_raised(spark, work):
    publish_rows(spark, work, [("a", "1")])

    def broken(batch, batch_id, run):
        raise RuntimeError("no room")

    stream = decode(read_topic(spark, "t", path=f"{work}/topics"), SCHEMA)
    query = runs.start(stream, "broken", broken, target="x", checkpoint_root=f"{work}/c",
                       available_now=True)
    with pytest.raises(Exception, match="no room"):
        runs.run_bounded(query)


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runs.shared_folder(Session)
    Session.conf = Conf({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/y/"})
    assert runs.shared_folder(Session) == "hdfs://x/y"


# --- latest row of each key as state ---------------------------------------

KEYED = "k string, at long, v string"


def keyed_run(spark, work, query="latest", sink=None, available_now=True, **options):
    messages = read_topic(spark, "t", path=f"{work}/topics", options=options or {"maxFilesPerTrigger": "1"})
    rows = decode(messages, strings(["k", "at", "v"])).select("k", F.col("at").cast("long").alias("at"), "v")
    return keep_latest(rows, query, "k", ["at"], target="state", checkpoint_root=f"{work}/checkpoints", sink=sink,
                       available_now=available_now)


def write(spark, work, *writes):
    publish(spark.createDataFrame(list(writes), KEYED).coalesce(1), "t", path=f"{work}/topics")


def kept(spark, work, query="latest"):
    rows = latest_rows(spark, f"{work}/checkpoints", query, KEYED, "k", ["at"])
    assert rows.columns == ["k", "at", "v"]
    return sorted((r.k, r.at, r.v) for r in rows.collect())


def brute_force(writes):
    latest = {}
    for k, at, v in writes:
        if k not in latest or (at, v) > latest[k][1:]:
            latest[k] = (k, at, v)
    return sorted(latest.values())


def test_no_state_before_the_first_batch(spark, work):
    assert kept(spark, work) == []


def test_last_write_wins_and_a_late_one_does_not(spark, work):
    write(spark, work, ("a", 1, "old"), ("a", 2, "new"))
    runs.run_bounded(keyed_run(spark, work))
    assert kept(spark, work) == [("a", 2, "new")]
    write(spark, work, ("a", 1, "late"), ("b", 1, "b"))
    runs.run_bounded(keyed_run(spark, work))
    assert kept(spark, work) == [("a", 2, "new"), ("b", 1, "b")]
    # Nothing new: the state is as it was.
    runs.run_bounded(keyed_run(spark, work))
    assert kept(spark, work) == [("a", 2, "new"), ("b", 1, "b")]


@pytest.mark.parametrize("seed", range(2))
def test_any_split_and_any_stop_gives_the_same_rows(spark, work, seed):
    rng = random.Random(seed)
    # Half of all writes go to one key.
    writes = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(12)}", rng.randrange(30), rng.choice("xyz")) for _ in range(120)]
    parts = [[] for _ in range(4)]
    for one in writes:
        rng.choice(parts).append(one)
    for part in parts:
        write(spark, work, *part)
        if rng.random() < 0.6:
            runs.run_bounded(keyed_run(spark, work))
    runs.run_bounded(keyed_run(spark, work))
    assert kept(spark, work) == brute_force(writes)


def test_sink_gets_the_changed_rows_alone(spark, work):
    seen = {}

    def sink(batch, batch_id, run):
        seen[batch_id] = sorted((r.k, r.at, r.v) for r in batch.collect())

    write(spark, work, ("a", 1, "x"), ("b", 1, "x"))
    write(spark, work, ("b", 2, "y"), ("b", 1, "z"), ("c", 1, "x"))
    runs.run_bounded(keyed_run(spark, work, sink=sink))
    assert seen == {0: [("a", 1, "x"), ("b", 1, "x")], 1: [("b", 2, "y"), ("c", 1, "x")]}


def test_batch_that_failed_counts_once(spark, work):
    """The sink fails after the state was worked out; the batch is played again and the state is right."""
    write(spark, work, ("a", 1, "x"))
    runs.run_bounded(keyed_run(spark, work, sink=lambda batch, *_: batch.collect()))
    write(spark, work, ("a", 2, "y"), ("b", 1, "x"))

    def broken(batch, batch_id, run):
        batch.collect()
        raise RuntimeError("no room")

    with pytest.raises(Exception, match="no room"):
        runs.run_bounded(keyed_run(spark, work, sink=broken))
    assert kept(spark, work) == [("a", 1, "x")]
    runs.run_bounded(keyed_run(spark, work, sink=lambda batch, *_: batch.collect()))
    assert kept(spark, work) == [("a", 2, "y"), ("b", 1, "x")]


def test_a_hot_key_sends_one_row_a_task(spark, work):
    rows = spark.range(1000).selectExpr("'hot' AS k", "id AS at", "string(id) AS v")
    from feedloom.operators.latest import latest_per_key
    plan = latest_per_key(rows, "k", ["at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange")  # below the exchange


# --- batches as a table ----------------------------------------------------

def test_batches_tell_rows_and_counts(spark, work):
    for n in (3, 5):
        publish_rows(spark, work, [(str(i), "1" if i % 2 else None) for i in range(n)])
    stream = decode(read_topic(spark, "t", path=f"{work}/topics", options={"maxFilesPerTrigger": "1"}), SCHEMA)
    query = runs.start(
        tagged(stream, {"no v": F.col("v").isNotNull()}), "counted", append_sink(f"{work}/target"),
        target="t", checkpoint_root=f"{work}/c", available_now=True)
    runs.run_bounded(query)
    got = runs.batches(spark, query).orderBy("batch_id").collect()
    assert [(r.query, r.batch_id, r.rows, r.counts) for r in got] == [
        ("counted", 0, 3, {"good": 1, "rejected": 2}), ("counted", 1, 5, {"good": 2, "rejected": 3})]
    assert got[0].started < got[1].started and all(r.seconds > 0 for r in got)
    assert appended(spark, work) == [("1", "1"), ("1", "1"), ("3", "1")]
    bad = read_batches(spark, f"{work}/target", "k string, reasons array<string>", "rejected").collect()
    assert len(bad) == 5 and all(r.reasons == ["no v"] for r in bad)


def test_no_batches_without_queries(spark):
    assert runs.batches(spark).count() == 0


def test_interval_keeps_batches_apart(spark, work):
    for n in range(3):
        publish_rows(spark, work, [(str(n), None)])
    stream = decode(read_topic(spark, "t", path=f"{work}/topics", options={"maxFilesPerTrigger": "1"}), SCHEMA)
    query = runs.start(stream, "paced", append_sink(f"{work}/target"), target="t", checkpoint_root=f"{work}/c", every="2 seconds")
    assert runs.run_batches(query, 2, 60) and not query.isActive
    ticks = [int(r.started.timestamp() // 2) for r in runs.batches(spark, query).orderBy("batch_id").collect()]
    assert len(ticks) == 3 and len(set(ticks)) == 3


def test_waiting_for_a_batch_that_does_not_come(spark, work):
    publish_rows(spark, work, [("a", None)])
    stream = decode(read_topic(spark, "t", path=f"{work}/topics"), SCHEMA)
    query = runs.start(stream, "short", append_sink(f"{work}/target"), target="t", checkpoint_root=f"{work}/c", every="1 second")
    assert not runs.run_batches(query, 9, 4) and not query.isActive


def test_numbers_in_order_and_gapless(spark, work):
    rng = random.Random(3)
    values = [rng.choice([None, *range(20)]) for _ in range(500)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i long").repartition(5)
    got = store_numbered(df, ["v", "i"], f"{work}/numbered").orderBy("position").collect()
    order = sorted(((v, i) for i, v in enumerate(values)), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [(r.v, r.i) for r in got] == order and [r.position for r in got] == list(range(500))
    assert store_numbered(df.limit(0), ["v"], f"{work}/none").count() == 0


# --- jobs -----------------------------------------------------------------

def test_order_of_writing_in_a_topic_of_files(spark, work):
    """Of two messages of a key in one publish the later wins, though its text is less."""
    records = spark.range(2000).repartition(4).sortWithinPartitions("id").selectExpr("concat('n', id) AS v", "id")
    publish(records, "t", path=f"{work}/topics")
    messages = read_topic(spark, "t", path=f"{work}/topics", stream=False)
    told = messages.selectExpr("partition", "offset", "get_json_object(string(value), '$.id') AS id").orderBy(
        "partition", "offset").collect()
    assert [int(r.id) for r in told] == [r.id for r in records.collect()]


def test_batch_published_twice_is_there_once(spark, work):
    records = spark.createDataFrame([("a", "1")], SCHEMA)
    for _ in range(2):
        publish(records, "t", path=f"{work}/topics", batch_id=3, run="r")
    publish(records, "t", path=f"{work}/topics")
    assert read_topic(spark, "t", path=f"{work}/topics", stream=False).count() == 2


def test_catalog_table_keeps_its_place(spark, work):
    from feedloom.sinks.catalog import create_namespace, create_table, replace_table

    database = f"places_{abs(hash(work))}"
    create_namespace(spark, database, f"{work}/db")
    for name in ("one", "two"):
        replace_table(spark.createDataFrame([(name, "1")], SCHEMA), f"{database}.{name}", SCHEMA, f"{work}/{name}")
    before = spark.table(f"{database}.one")
    with pytest.raises(ValueError, match="was created for"):
        create_table(spark, f"{database}.one", SCHEMA, f"{work}/elsewhere")
    replace_table(spark.createDataFrame([("new", None)], SCHEMA), f"{database}.one", SCHEMA, f"{work}/one")
    assert [r.k for r in before.collect()] == ["one"]  # a reader of the old content
    assert [r.k for r in spark.table(f"{database}.one").collect()] == ["new"]
    assert [r.k for r in spark.table(f"{database}.two").collect()] == ["two"]


def test_user_jobs(spark, work):
    from test_flatten import payload

    payloads = spark.createDataFrame([(payload(),), ('{"results":[]}',)], "raw string")
    topic = Topic(path=f"{work}/topics")
    jobs.publish_users(payloads, topic, rejected=f"{work}/rejected")
    assert [r.raw for r in spark.read.parquet(f"{work}/rejected").collect()] == ['{"results":[]}']

    key = F.lit("123e4567-e89b-12d3-a456-426614174000")
    runs.run_bounded(jobs.users_to_table(
        spark, topic, f"{work}/c", available_now=True, field_aliases={"postcode": "post_code"}, key_expr={"id": key}))
    user = jobs.created_users(spark, f"{work}/c").first()
    assert (user.id, user.first_name, user.post_code) == (key._jc.toString().strip("'"), "José", "90210")
    runs.run_bounded(jobs.users_to_table(spark, topic, f"{work}/keyless", available_now=True))
    assert jobs.created_users(spark, f"{work}/keyless").count() == 0

    query = jobs.users_rejected(spark, topic, f"{work}/bad", f"{work}/c", available_now=True)
    runs.run_bounded(query)
    bad = read_batches(spark, f"{work}/bad", "first_name string, reasons array<string>", "rejected").first()
    assert (bad.first_name, bad.reasons) == ("José", ["no id", "id is no UUID"])
    assert runs.batches(spark, query).first().counts == {"good": 0, "rejected": 1}

    runs.run_bounded(jobs.users_to_documents(
        spark, topic, f"{work}/documents", f"{work}/c", available_now=True))
    document = read_batches(spark, f"{work}/documents", jobs.CREATED_USER).first()
    assert (document.id, document.first_name, document.post_code) == (None, "José", None)


def test_responses_are_published_as_they_arrive(spark, work):
    from test_flatten import payload

    os.makedirs(f"{work}/arrived")
    topic = Topic(path=f"{work}/topics")

    def arrive(name, *lines):
        with open(f"{work}/arrived/{name}", "w") as out:
            out.write("".join(line + "\n" for line in lines))

    def run(**options):
        runs.run_bounded(jobs.publish_responses(
            spark, f"{work}/arrived", topic, f"{work}/c", rejected=f"{work}/rejected", available_now=True, **options))

    arrive("one.txt", payload(), '{"results":[]}', "")
    run()
    arrive("two.txt", payload(), "no json")
    run()
    run()
    read = read_topic(spark, topic.name, path=topic.path, stream=False, with_batch=True).collect()
    assert sorted(r.batch_id for r in read) == [0, 1]
    assert all(json.loads(r.value)["first_name"] == "José" and r.key is None for r in read)
    bad = spark.read.parquet(f"{work}/rejected").collect()
    assert sorted((r.batch_id, r.raw) for r in bad) == [(0, ""), (0, '{"results":[]}'), (1, "no json")]


def test_paced_publisher_goes_on_where_it_stopped(spark, work):
    records = spark.range(23).selectExpr("id", "string(id) AS v").repartition(3)
    numbered = store_numbered(records, ["id"], f"{work}/numbered")
    topic = Topic("t", path=f"{work}/topics")
    for last in (0, 5):
        assert runs.run_batches(jobs.publish_paced(numbered, topic, f"{work}/c", per_batch=5), last)
    read = read_topic(spark, "t", path=topic.path, stream=False, with_batch=True).selectExpr(
        "batch_id", "cast(get_json_object(string(value), '$.id') AS long) AS id").collect()
    assert sorted((r.id, r.batch_id) for r in read) == [(i, i // 5) for i in range(23)]
