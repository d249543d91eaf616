"""Metrics as a long table: collecting, appending, comparing phases, checking objectives."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# The columns of the metric log, in file order.
LOG_COLUMNS = (
    "run_id", "stage", "task", "phase", "metric_name", "metric_value",
    "shuffle_read_bytes", "shuffle_write_bytes", "elapsed_ms", "notes", "timestamp",
)


def metric_rows(summary: DataFrame, *, stage: str, task: str, metrics: Sequence[str], phase: str = "baseline",
                label: str | None = None) -> DataFrame:
    """Turn the named columns of ``summary`` into one row per metric.

    With ``label`` the value of that column is put behind the metric name, one metric per group.
    """
    name = F.lit("") if label is None else F.concat(F.lit("_"), F.col(label).cast("string"))
    entries = F.array(*[
        F.struct(F.concat(F.lit(m), name).alias("metric_name"), F.col(m).cast("double").alias("metric_value"))
        for m in metrics
    ])
    return summary.select(F.explode(entries).alias("m")).select(
        F.lit(stage).alias("stage"), F.lit(task).alias("task"), F.lit(phase).alias("phase"),
        "m.metric_name", "m.metric_value",
    )


def log_rows(rows: DataFrame, run_id: str, *, elapsed_ms: float | Mapping[str, float] | None = None,
             notes: str = "") -> DataFrame:
    """Complete metric rows to the log layout. Fields the caller does not measure stay null.

    ``elapsed_ms`` is one time, or a time per task.
    """
    empty = F.lit(None)
    took = F.lit(elapsed_ms) if not isinstance(elapsed_ms, Mapping) else (
        F.get(F.map_values(F.map_filter(F.create_map(*[F.lit(x) for pair in elapsed_ms.items() for x in pair]),
                                        lambda task, _: task == F.col("task"))), F.lit(0)))
    return rows.select(
        F.lit(run_id).alias("run_id"), "stage", "task", "phase", "metric_name", "metric_value",
        empty.cast("bigint").alias("shuffle_read_bytes"), empty.cast("bigint").alias("shuffle_write_bytes"),
        took.cast("double").alias("elapsed_ms"), F.lit(notes).alias("notes"),
        F.current_timestamp().alias("timestamp"),
    )


def append_metrics(log: DataFrame, path: str) -> None:
    """Add rows to the log; earlier runs stay."""
    log.select(*LOG_COLUMNS).write.mode("append").parquet(path)


def metrics_compare(metrics: DataFrame, *, base: str, other: str) -> DataFrame:
    """Both phases of every metric side by side and the change in percent; null for a zero base."""
    at = lambda phase: F.max(F.when(F.col("phase") == phase, F.col("metric_value")))
    sides = metrics.groupBy("stage", "task", "metric_name").agg(at(base).alias("base"), at(other).alias("other"))
    return sides.withColumn("change_pct", F.try_divide((F.col("other") - F.col("base")) * 100, F.col("base")))


def slo_check(spark: SparkSession, metrics: DataFrame, limits: Mapping[str, tuple[str, float]],
              run_id: str | None = None, phase: str | None = None) -> DataFrame:
    """PASS or FAIL per limited metric, limits inclusive; MISSING if the metric was not reported.

    The log is append-only: ``run_id`` and ``phase`` choose the rows that are judged. Of several rows of one metric the worst counts.

    ``limits`` maps a metric name to ``("max" | "min", threshold)``.
    """
    table = spark.createDataFrame(
        [(name, kind, float(limit)) for name, (kind, limit) in limits.items()],
        "metric_name string, kind string, threshold double")
    for column, wanted in (("run_id", run_id), ("phase", phase)):
        if wanted is not None:
            metrics = metrics.filter(F.col(column) == wanted)
    value, limit = F.col("metric_value"), F.col("threshold")
    held = F.when(F.col("kind") == "max", value <= limit).otherwise(value >= limit)
    status = F.when(value.isNull(), "MISSING").when(held, "PASS").otherwise("FAIL")
    sides = metrics.groupBy("metric_name").agg(F.min("metric_value").alias("low"), F.max("metric_value").alias("high"))
    worst = F.when(F.col("kind") == "max", F.col("high")).otherwise(F.col("low"))
    judged = table.join(sides, "metric_name", "left").withColumn("metric_value", worst)
    return judged.select(
        "metric_name", "kind", "threshold", "metric_value", status.alias("status"))
