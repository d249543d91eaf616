"""The state of a stopped stream, read back from its checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rondel.streaming.sinks import SinkPaths


def stores(spark: SparkSession, paths: SinkPaths) -> DataFrame:
    """One row per stateful operator and store: its name, number of partitions, and the batches it can be read at."""
    return spark.read.format("state-metadata").load(paths.checkpoint)


def entries(spark: SparkSession, paths: SinkPaths, *, operator: int = 0, batch: int | None = None) -> DataFrame:
    """The rows of one operator's state after the last committed batch, or after ``batch``: ``partition_id, key, value``."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader if batch is None else reader.option("batchId", batch)).load(paths.checkpoint)


def open_windows(spark: SparkSession, paths: SinkPaths, *, by: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Windows of ``tumbling_agg`` that are still open: what the stream has gathered and not yet written.

    ``measures`` are made from the aggregation buffers, ``b0, b1, ...`` in the order of the query's measures: a count has one, a
    mean two, sum and count.
    """
    held = entries(spark, paths)
    fields = held.schema["key"].dataType.fields
    window = next(f.name for f in fields if f.name not in by)
    buffers = ", ".join(f"b{i}: {f.dataType.simpleString()}" for i, f in enumerate(held.schema["value"].dataType.fields))
    keys = F.col("key")
    flat = held.select(
        keys[window]["start"].alias("window_start"), keys[window]["end"].alias("window_end"),
        *[keys[c].alias(c) for c in by], F.col("value").cast(f"struct<{buffers}>").alias("value"))
    return flat.select("window_start", "window_end", *by, "value.*").select(
        "window_start", "window_end", *by, *[c.alias(name) for name, c in measures.items()])
