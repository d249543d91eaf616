import pytest
from pyspark.sql import functions as F

from rondel.operators import evidence
from rondel.sources import files, layout


@pytest.fixture
def dated(spark):
    return spark.range(2000).select(
        "id", F.lit(2020).alias("year"), (F.col("id") % 4 + 1).cast("int").alias("month"))


def test_compaction_keeps_rows_and_shrinks_the_file_count(spark, dated, tmp_path):
    before, after = str(tmp_path / "before"), str(tmp_path / "after")
    dated.repartition(6).write.partitionBy("year", "month").parquet(before)
    layout.compact(spark, before, after, ["year", "month"], ["id"])
    assert sorted(spark.read.parquet(before).collect()) == sorted(spark.read.parquet(after).collect())
    files_of = {r["phase"]: r["files"] for r in layout.layout_stats(spark, {"before": before, "after": after}).collect()}
    assert files_of == {"before": 24, "after": 4}


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    hot = spark.range(0, 200_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("pad"), F.when(F.col("id") < 180_000, 1).otherwise(2).alias("k"))
    kept = {c: spark.conf.get(c, None) for c in (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        layout.write_partitioned(hot, path, ["k"])
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value) if value else spark.conf.unset(key)
    per_value = layout.file_inventory(spark, path).groupBy(
        F.regexp_extract("path", "k=([0-9]+)", 1).alias("k")).count().collect()
    assert {r["k"]: r["count"] > 1 for r in per_value}["1"]
    assert spark.read.parquet(path).count() == 200_000


def test_month_filter_prunes_directories(spark, dated, tmp_path):
    path = str(tmp_path / "table")
    layout.write_partitioned(dated, path, ["year", "month"])
    scan = files.read_parquet(spark, path, ["id"], (F.col("year") == 2020) & (F.col("month") == 3))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<id:bigint>" in plan
    assert scan.count() == 500


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    scan = files.read_parquet(spark, f"{sf_dir}/orders.parquet", ["o_orderkey"], F.col("o_orderstatus") == "F")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_inventory_does_not_read_contents(spark, dated, tmp_path):
    path = str(tmp_path / "t")
    dated.write.parquet(path)
    plan = layout.file_inventory(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_footprint(spark, dated, tmp_path):
    paths = {f: str(tmp_path / f) for f in ("parquet", "csv")}
    dated.write.parquet(paths["parquet"])
    files.write_csv(dated, paths["csv"])
    row = layout.footprint_ratio(layout.layout_stats(spark, paths), "parquet", "csv").first()
    assert row["ratio"] == pytest.approx(row["subject_bytes"] / row["reference_bytes"])


@pytest.fixture
def metrics(spark):
    return spark.createDataFrame(
        [("s", "t", "base", "m", 100.0), ("s", "t", "tuned", "m", 150.0),
         ("s", "t", "base", "z", 0.0), ("s", "t", "tuned", "z", 5.0)],
        "stage string, task string, phase string, metric_name string, metric_value double")


def test_change_is_undefined_for_a_zero_base(metrics):
    got = {r["metric_name"]: r["change_pct"] for r in evidence.metrics_compare(metrics, base="base", other="tuned").collect()}
    assert got == {"m": 50.0, "z": None}


def test_limits_are_inclusive(spark, metrics):
    base = metrics.filter("phase = 'base'")
    got = {r["metric_name"]: r["status"] for r in evidence.slo_check(
        spark, base, {"m": ("max", 100), "z": ("min", 1), "none": ("max", 1)}).collect()}
    assert got == {"m": "PASS", "z": "FAIL", "none": "MISSING"}


def test_log_is_append_only(spark, metrics, tmp_path):
    path = str(tmp_path / "log")
    for run in ("r1", "r2"):
        evidence.append_metrics(evidence.log_rows(metrics, run, elapsed_ms=1.5, notes="n"), path)
    log = spark.read.parquet(path)
    assert tuple(log.columns) == evidence.LOG_COLUMNS
    assert {r["run_id"]: r["count"] for r in log.groupBy("run_id").count().collect()} == {"r1": 4, "r2": 4}


def test_compaction_in_place_rewrites_crowded_partitions_only(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "staging")
    rows = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad"),
                                    F.when(F.col("id") % 4 == 0, "a+ b").otherwise("c/d").alias("k"))
    rows.filter("k = 'c/d'").repartition(9).write.partitionBy("k").parquet(path)
    rows.filter("k = 'a+ b'").coalesce(1).write.mode("append").partitionBy("k").parquet(path)
    files = lambda: {(r["k"], r["path"]): r["bytes"] for r in layout.partition_files(spark, path, ["k"]).collect()}
    before = files()
    whole = sum(size for (k, _), size in before.items() if k == "c/d")
    assert layout.compact_in_place(spark, path, ["k"], ["id"], staging=staging, target_bytes=whole // 3 + 1) == 9
    after = files()
    assert {x for x in before if x[0] == "a+ b"} == {x for x in after if x[0] == "a+ b"}
    assert sum(k == "c/d" for k, _ in after) == 3
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "pad", "k").collect())) == sorted(map(tuple, rows.collect()))
    assert layout.compact_in_place(spark, path, ["k"], staging=staging, target_bytes=whole) == 3
    assert layout.compact_in_place(spark, path, ["k"], staging=staging, target_bytes=whole * 2) == 0


def test_worst_row_of_a_metric_counts(spark):
    rows = spark.createDataFrame([("r", "m", 1.0), ("r", "m", 9.0), ("q", "m", 99.0)], "run_id string, metric_name string, metric_value double")
    got = evidence.slo_check(spark, rows, {"m": ("max", 5)}, run_id="r").collect()
    assert [(r["metric_value"], r["status"]) for r in got] == [(9.0, "FAIL")]
