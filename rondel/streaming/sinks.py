"""Checkpointed Parquet sinks for streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rondel.session import settings
from rondel.streaming import progress


@dataclass(frozen=True)
class SinkPaths:
    """Output and checkpoint of one stream. They belong together and share one root."""

    data: str
    checkpoint: str

    @property
    def reports(self) -> str:
        """Where the progress reports of followed runs are stored."""
        return f"{self.checkpoint}-reports"

    @classmethod
    def under(cls, root: str) -> SinkPaths:
        return cls(f"{root}/data", f"{root}/checkpoint")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def check_pairing(spark: SparkSession, paths: SinkPaths) -> None:
    """Refuse a used sink under a fresh checkpoint.

    The sink's own log would make Spark skip every batch number it already holds, and the
    stream would silently write nothing.
    """
    if _exists(spark, f"{paths.data}/_spark_metadata") and not _exists(spark, f"{paths.checkpoint}/offsets"):
        raise ValueError(f"{paths.data} holds the output of another checkpoint; use a new root")


# Settings that a starting query copies, as Spark names them.
_STATE_SETTINGS = {
    "rocksdb": {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    },
    "memory": {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
    },
}


def start_append(stream: DataFrame, paths: SinkPaths, *, every: str | None = None,
                 state_partitions: int | None = None, state_store: str = "rocksdb") -> StreamingQuery:
    """Start an append query: a processing-time trigger if ``every`` is given, else one drain.

    ``state_partitions`` is the number of state stores, and of files per batch. A checkpoint keeps
    the number of its first start for good; without it the session's shuffle setting is taken. State is held by ``rocksdb`` on
    local disk, so it may outgrow memory, and a batch uploads only what it changed; ``memory`` keeps it on the heap. A checkpoint
    keeps its kind of store, too.
    """
    check_pairing(stream.sparkSession, paths)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", paths.data)
        .option("checkpointLocation", paths.checkpoint)
    )
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    wanted = dict(_STATE_SETTINGS[state_store])
    if state_partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    with settings(stream.sparkSession, wanted):
        return trigger.start()


def run_for(query: StreamingQuery, seconds: int, paths: SinkPaths) -> StreamingQuery:
    """Let a continuous query run for a bounded time, then stop it; its reports are stored as those of a drain."""
    progress.follow(query, paths.reports, seconds)
    return query


def run_triggered(stream: DataFrame, paths: SinkPaths, every: str, **store) -> StreamingQuery:
    """Let a processing-time trigger work through everything that has landed, then stop the query.

    The last windows to close need one more batch, which a drain of the same checkpoint gives them.
    """
    query = start_append(stream, paths, every=every, **store)
    query.processAllAvailable()
    progress.follow(query, paths.reports, 0)
    return query


def drain(stream: DataFrame, paths: SinkPaths, *, state_partitions: int | None = None,
          state_store: str = "rocksdb") -> StreamingQuery:
    """Process everything that has landed, then stop. Safe to call again after new files land."""
    query = start_append(stream, paths, state_partitions=state_partitions, state_store=state_store)
    progress.follow(query, paths.reports)
    return query


def read_sink(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """Committed output only: the reader follows the sink's log."""
    return spark.read.parquet(paths.data)
