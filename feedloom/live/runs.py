"""Starting and ending queries over streams, where they keep their progress, and what batches they have worked off."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

BatchSink = Callable[[DataFrame, int, str], None]


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may go without one; it gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="feedloom-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run; nothing is ever deleted from it."""
    return f"{shared_folder(spark)}/feedloom/{name}-{uuid.uuid4().hex}"


def claim_checkpoint(spark: SparkSession, root: str, query: str, target: str) -> tuple[str, str]:
    """(checkpoint folder, run id) of a query; refuses one that feeds another target.

    A query that started on a foreign checkpoint would begin at the other's
    offsets and skip its data without a word. The run id lives as long as the
    checkpoint, so that (run id, batch id) names a micro-batch for good: a new
    checkpoint starts again at batch 0 but not at the same name.
    """
    folder = f"{root}/{query}"
    owner = f"{folder}/owner"
    try:
        claim = spark.read.schema("query string, target string, run string").json(owner).head()
    except AnalysisException:
        claim = None
    if claim is None:
        run = uuid.uuid4().hex
        spark.createDataFrame([(query, target, run)], "query string, target string, run string") \
            .coalesce(1).write.mode("errorifexists").json(owner)
    elif (claim.query, claim.target) != (query, target):
        raise ValueError(
            f"checkpoint {folder} belongs to query {claim.query!r} writing to {claim.target!r}"
        )
    else:
        run = claim.run
    return f"{folder}/progress", run


def start(
    stream: DataFrame,
    query: str,
    sink: BatchSink | None,
    *,
    target: str,
    checkpoint_root: str,
    every: str | None = None,
    available_now: bool = False,
    output_mode: str = "append",
):
    """Start a query that hands (batch, batch id, run id) to ``sink``; does not wait.

    By default a batch starts when the last ends; ``every`` paces them, e.g.
    "5 seconds"; ``available_now`` works off what is there and ends. Without a sink
    the batches are worked off for what they leave in the query's state.
    """
    checkpoint, run = claim_checkpoint(stream.sparkSession, checkpoint_root, query, target)
    writer = stream.writeStream.queryName(query).outputMode(output_mode).option("checkpointLocation", checkpoint)
    if sink:
        writer = writer.foreachBatch(lambda batch, batch_id: sink(batch, batch_id, run))
    else:
        writer = writer.format("noop")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def run_bounded(query, timeout: float | None = 180) -> bool:
    """Wait for at most ``timeout`` seconds, then stop; True if the query ended by itself.

    A failure of the query is raised. Stopping within a batch is safe, it is run
    again on the next start.
    """
    try:
        return bool(query.awaitTermination(timeout)) if timeout else query.awaitTermination() is None
    finally:
        if query.isActive:
            query.stop()


def run_batches(query, last: int, timeout: float = 180) -> bool:
    """Wait until batch ``last`` has ended, then stop; False if that took longer than ``timeout`` seconds.

    For sources that never end. A failure of the query is raised.
    """
    limit = time.monotonic() + timeout
    try:
        while time.monotonic() < limit:
            if query.awaitTermination(0.1):
                return False
            if query.lastProgress and query.lastProgress.batchId >= last:
                return True
        return False
    finally:
        if query.isActive:
            query.stop()


_BATCH = "query string, run string, batch_id long, started timestamp, rows long, seconds double, counts map<string,long>"


def batches(spark: SparkSession, *queries) -> DataFrame:
    """The batches that queries have worked off, as a table; those without input are left out.

    (query, run, batch_id, started, rows, seconds, counts): ``run`` is another with each start, ``counts`` holds
    what the stream counts while its rows pass (``operators.validity.tagged``). A query that runs on or has ended remembers its
    last triggers, 100 by default.
    """
    rows = []
    for query in queries:
        for progress in query.recentProgress:
            if not progress.numInputRows:
                continue
            counts = {k: v for seen in progress.observedMetrics.values() for k, v in seen.asDict().items()}
            started = datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
            rows.append((
                progress.name, str(progress.runId), progress.batchId, started, progress.numInputRows,
                progress.batchDuration / 1000, counts))
    return spark.createDataFrame(rows, _BATCH)
