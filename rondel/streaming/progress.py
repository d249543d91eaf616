"""Micro-batch progress as a table."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rondel.session import settings

# The progress fields that are kept, as Spark names them.
PROGRESS_SCHEMA = """
    id string, runId string, batchId bigint, timestamp string, numInputRows bigint,
    inputRowsPerSecond double, processedRowsPerSecond double,
    durationMs map<string,bigint>, eventTime map<string,string>,
    stateOperators array<struct<operatorName: string, numRowsTotal: bigint, numRowsUpdated: bigint,
        numRowsDroppedByWatermark: bigint, numShufflePartitions: bigint, memoryUsedBytes: bigint,
        commitTimeMs: bigint>>,
    observedMetrics map<string,map<string,bigint>>
"""


# Reports that Spark is told to hold, and after how many batches or looks they are stored.
RETAINED = 10_000
TAKEN_AFTER = 1_000
_LOOK_S = 1
_RETENTION = "spark.sql.streaming.numRecentProgressUpdates"

# The table of stored reports of each followed run.
_STORED: dict[str, str] = {}


def follow(query: StreamingQuery, path: str, seconds: int | None = None) -> None:
    """Wait until the query ends, or stop it after ``seconds``; every report is appended to the table at ``path``.

    Reports leave Spark's own list in time, so a run may have any number of batches.
    """
    spark, last, batch, looks = SparkSession.active(), None, -1, 0
    until = None if seconds is None else time.monotonic() + seconds

    def take() -> None:
        nonlocal last, batch, looks
        reports = [p.json if hasattr(p, "json") else json.dumps(p) for p in query.recentProgress]
        if last is not None:
            if last not in reports:
                raise RuntimeError(f"reports of {query.runId} were lost before they were stored")
            reports = reports[reports.index(last) + 1:]
        looks = 0
        if reports:
            spark.createDataFrame([(r,) for r in reports], "report string").write.mode("append").text(path)
            last, batch = reports[-1], json.loads(reports[-1])["batchId"]
            _STORED[str(query.runId)] = path

    wanted = {_RETENTION: str(max(RETAINED, int(spark.conf.get(_RETENTION))))}  # read while the query runs
    with settings(spark, wanted):
        try:
            while not query.awaitTermination(_LOOK_S if until is None else max(0.01, min(_LOOK_S, until - time.monotonic()))):
                looks += 1
                now = query.lastProgress
                if looks >= TAKEN_AFTER or (now is not None and now["batchId"] - batch >= TAKEN_AFTER):
                    take()
                if until is not None and time.monotonic() >= until:
                    query.stop()
        finally:
            take()


def progress_table(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """One row per reported batch and label: all batches of a followed run.

    Of other runs Spark holds the most recent batches; if earlier ones are gone, that is an error.
    """
    tables, reports = [], []
    for label, query in queries.items():
        path = _STORED.get(str(query.runId))
        if path is not None:
            mine = spark.read.text(path).select(F.lit(label).alias("label"), F.col("value").alias("report"))
            tables.append(mine.filter(F.get_json_object("report", "$.runId") == str(query.runId)))
            continue
        held = [p.json if hasattr(p, "json") else json.dumps(p) for p in query.recentProgress]
        if len(held) >= int(spark.conf.get(_RETENTION)):
            raise RuntimeError(f"earlier reports of {label} may be gone; use progress.follow")
        reports += [(label, r) for r in held]
    raw = spark.createDataFrame(reports, "label string, report string")
    for mine in tables:
        raw = raw.unionByName(mine)
    return _read(raw)


def _read(reports: DataFrame) -> DataFrame:
    return reports.select("label", F.from_json("report", PROGRESS_SCHEMA).alias("p")).select("label", "p.*")


def stored_reports(spark: SparkSession, path: str, label: str) -> DataFrame:
    """One row per batch of all followed runs of one checkpoint, from the table that they share."""
    return _read(spark.read.text(path).select(F.lit(label).alias("label"), F.col("value").alias("report")))


def progress_summary(progress: DataFrame) -> DataFrame:
    """Means over the batches that had input, per label, with state and late-drop totals over all state operators."""
    has_state = F.size("stateOperators") > 0
    add = lambda field: lambda total, operator: total + F.coalesce(operator.getField(field), F.lit(0).cast("long"))
    state = lambda field: F.when(has_state, F.aggregate("stateOperators", F.lit(0).cast("long"), add(field)))
    busy = F.col("numInputRows") > 0
    when_busy = lambda c: F.avg(F.when(busy, c))
    return progress.groupBy("label").agg(
        F.count_if(busy).alias("batches_sampled"),
        F.sum("numInputRows").alias("input_rows"),
        when_busy(F.col("numInputRows")).alias("avg_input_rows"),
        when_busy(F.col("processedRowsPerSecond")).alias("avg_processed_rows_s"),
        when_busy(F.col("durationMs")["triggerExecution"]).alias("avg_trigger_exec_ms"),
        when_busy(F.col("durationMs")["addBatch"]).alias("avg_add_batch_ms"),
        F.max(state("numRowsTotal")).alias("max_state_rows"),
        F.sum(state("numRowsDroppedByWatermark")).alias("dropped_partial_groups"),
        F.max(F.array_max(F.transform("stateOperators", lambda o: o["numShufflePartitions"]))).alias("state_partitions"),
    )
