"""Tumbling-window aggregates that read the same on a batch and on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def tumbling_agg(events: DataFrame, *, time: str, width: str, by: Sequence[str], measures: Sequence[Column],
                 delay: str | None = None) -> DataFrame:
    """``measures`` per window of ``width`` and group, with the window as two columns.

    On a stream pass ``delay``: it bounds the state and lets append mode emit a window once the
    watermark passes its end. On a batch the watermark has no effect and may be left out.
    """
    source = events.withWatermark(time, delay) if delay else events
    grouped = source.groupBy(F.window(time, width).alias("w"), *by).agg(*measures)
    names = [c for c in grouped.columns if c != "w"]
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *names)


def closed_windows(windowed: DataFrame, events: DataFrame, *, time: str, delay: str) -> DataFrame:
    """The windows a drained append stream has emitted: end at or before newest event minus delay."""
    newest = events.agg(F.max(time)).scalar()
    return windowed.filter(F.col("window_end") <= newest - F.expr(f"interval {delay}"))


ROWS = "rows"


def once_on_time(events: DataFrame, *, key: str, time: str, width: str, delay: str) -> DataFrame:
    """A stream's rows that arrive before the window of ``width`` they fall in is closed, each ``key`` once per window.

    The engine drops late rows and counts them one by one, as nothing is combined before; all arriving rows are counted by an
    observation of the running plan. State holds a key until its window closes.
    """
    seen = events.observe(ROWS, F.count("*").alias("input_rows"))
    watched = seen.withWatermark(time, delay).withColumn("_window", F.window(time, width))
    # A stream may have one event-time column, here the window: the time itself goes on as a plain value.
    plain = watched.withColumn(time, F.col(time) + F.expr("interval 0 seconds"))
    return plain.dropDuplicates([key, "_window"]).drop("_window")


def late_rows(reports: DataFrame) -> DataFrame:
    """Input, on-time and late rows per ``label`` and run, from the progress reports of ``once_on_time`` streams.

    Nothing is derived again: input rows come from the observation, late rows from the state operator.
    """
    dropped = F.aggregate("stateOperators", F.lit(0).cast("long"),
                          lambda total, one: total + F.coalesce(one["numRowsDroppedByWatermark"], F.lit(0).cast("long")))
    arrived = F.coalesce(F.col("observedMetrics")[ROWS]["input_rows"], F.lit(0).cast("long"))
    per_run = reports.groupBy("label", "runId").agg(F.sum(arrived).alias("input_rows"), F.sum(dropped).alias("late_rows"))
    return per_run.withColumn("on_time_rows", F.col("input_rows") - F.col("late_rows"))
