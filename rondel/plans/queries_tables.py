"""Queries over files, layers, gold tables, layouts and the metric log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rondel.operators import aggregates, curation, evidence, quality, text_index
from rondel.plans import match_results as matches
from rondel.plans.registry import query
from rondel.plans.standins import PLAYS_SQL, RAW_COLUMNS, plays, raw_plays, table
from rondel.session import scratch_path
from rondel.sources import files, layout

# ---- files -----------------------------------------------------------------------------------

_ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


@query("csv_typed_scan", """
    SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders
""")
def csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders_csv")
    orders = table(spark, sf_dir, "orders")
    files.write_csv(orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P"))), path)
    return files.read_csv_typed(
        spark, path, _ORDER_SCHEMA,
        columns=["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])


@query("bronze_land", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
    FROM orders
""")
def bronze_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority")
    files.write_csv(raw, source)
    return files.land_raw(spark, source, target)


@query("parquet_scan", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice >= 250000
""")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(
        spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice"],
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 250000))


# ---- layers ----------------------------------------------------------------------------------

_RAW_SELECT = ", ".join(f"{e} AS {n}" for n, e in RAW_COLUMNS.items())
_RAW_SQL = f"(SELECT {_RAW_SELECT} FROM {PLAYS_SQL}) AS raw"
_TYPES = {f.name: f.dataType.simpleString().upper() for f in matches.RESULT_SCHEMA.fields}
_TYPED = ", ".join(
    c if t == "STRING" else f"TRY_CAST({c} AS {t}) AS {c}" for c, t in _TYPES.items())
_TIE_BREAK = ", ".join(f"{c} NULLS FIRST" for c in _TYPES if c not in matches.NATURAL_KEY)


@query("silver_clean", f"""
    SELECT * EXCLUDE (place), CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
           abs(result_1 - result_2) AS score_diff
    FROM (SELECT *, row_number() OVER (PARTITION BY match_id, _map ORDER BY {_TIE_BREAK}) AS place
          FROM (SELECT {_TYPED} FROM {_RAW_SQL}) AS typed
          WHERE date IS NOT NULL AND team_1 IS NOT NULL AND team_2 IS NOT NULL AND _map IS NOT NULL
            AND match_id IS NOT NULL AND result_1 IS NOT NULL AND result_2 IS NOT NULL) AS complete
    WHERE place = 1
""")
def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.silver(raw_plays(spark, sf_dir))


def _contract_sql() -> str:
    checks = []
    for name, kind in _TYPES.items():
        if name in (*matches.REQUIRED, *matches.MEASURES):
            checks.append((f"{name}_present", f"{name} IS NULL"))
        if kind != "STRING":
            checks.append((f"{name}_parses", f"{name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL"))
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) AS rows, count(*) FILTER (WHERE {broken}) AS violations, "
        f"CASE WHEN count(*) FILTER (WHERE {broken}) = 0 THEN 'OK' ELSE 'VIOLATED' END AS status FROM {_RAW_SQL}"
        for rule, broken in checks)


@query("contract_report", _contract_sql())
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.silver_contract(raw_plays(spark, sf_dir))


@query("contract_rejects", f"""
    SELECT match_id, _map, team_1, team_2,
           concat_ws(',', CASE WHEN date IS NULL THEN 'date_present' END,
                          CASE WHEN result_1 IS NULL THEN 'result_1_present' END,
                          CASE WHEN result_2 = 'n/a' THEN 'result_2_parses' END) AS reasons
    FROM {_RAW_SQL} WHERE date IS NULL OR result_1 IS NULL OR result_2 = 'n/a'
""")
def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = quality.rejects(raw_plays(spark, sf_dir), matches.silver_rules())
    return broken.select("match_id", "_map", "team_1", "team_2", F.array_join("reasons", ",").alias("reasons"))


@query("silver_balance", f"""
    WITH typed AS (SELECT {_TYPED} FROM {_RAW_SQL}),
    complete AS (SELECT * FROM typed
                 WHERE date IS NOT NULL AND team_1 IS NOT NULL AND team_2 IS NOT NULL AND _map IS NOT NULL
                   AND match_id IS NOT NULL AND result_1 IS NOT NULL AND result_2 IS NOT NULL),
    n AS (SELECT (SELECT count(*) FROM typed) AS bronze_rows, (SELECT count(*) FROM complete) AS complete_rows,
                 (SELECT count(*) FROM (SELECT DISTINCT match_id, _map FROM complete) AS k) AS silver_rows)
    SELECT bronze_rows, silver_rows, bronze_rows - complete_rows AS incomplete_rows,
           complete_rows - silver_rows AS duplicate_rows FROM n
""")
def silver_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.silver_balance(raw_plays(spark, sf_dir))


# ---- gold ------------------------------------------------------------------------------------

@query("group_count_avg", """
    SELECT event_type, count(*) AS n, avg(CAST(round(value * 100) AS BIGINT)) AS avg_value
    FROM events GROUP BY event_type
""")
def group_count_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    return aggregates.group_count_avg(table(spark, sf_dir, "events"), ["event_type"], cents)


@query("entity_period_stats", f"""
    SELECT team_1 AS team_name, year, count(*) AS maps_played, count(*) FILTER (WHERE map_winner = 1) AS maps_won,
           avg(rank_1) AS avg_rank, avg(score_diff) AS avg_score_diff, avg(result_1) AS avg_score,
           CAST(count(*) FILTER (WHERE map_winner = 1) AS DOUBLE) / count(*) AS win_rate
    FROM {PLAYS_SQL} GROUP BY team_1, year
""")
def entity_period_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.team_stats(plays(spark, sf_dir))


@query("category_month_stats", f"""
    SELECT _map, year, month, count(*) AS matches_played, avg(result_1) AS avg_score_t1,
           avg(result_2) AS avg_score_t2, avg(score_diff) AS avg_score_diff,
           count(DISTINCT event_id) AS events_count
    FROM {PLAYS_SQL} GROUP BY _map, year, month
""")
def category_month_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.map_stats(plays(spark, sf_dir))


_OUTCOME_SQL = f"""
    SELECT match_id, _map, date, year, month, team_1, team_2, result_1, result_2,
           CASE WHEN map_winner = 1 THEN team_1 ELSE team_2 END AS winner_name,
           CASE WHEN map_winner = 1 THEN team_2 ELSE team_1 END AS loser_name,
           CASE WHEN map_winner = 1 THEN result_1 ELSE result_2 END AS winner_score,
           CASE WHEN map_winner = 1 THEN result_2 ELSE result_1 END AS loser_score,
           rank_1, rank_2, score_diff, event_id
    FROM {PLAYS_SQL}
"""


@query("outcome_enrich", _OUTCOME_SQL)
def outcome_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches.match_results(plays(spark, sf_dir))


# ---- layout ----------------------------------------------------------------------------------

def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "*", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


def _partitioned_orders(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders_by_month")
    layout.write_partitioned(_dated_orders(spark, sf_dir), path, ["year", "month"], ["o_orderdate", "o_orderkey"])
    return path


_DATED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
           CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month
    FROM orders
"""


@query("partitioned_write", _DATED_SQL)
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_partitioned_orders(spark, sf_dir))


@query("partitioned_write_category", "SELECT event_id, ts, user_id, value, event_type FROM events")
def partitioned_write_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events_by_type")
    layout.write_partitioned(table(spark, sf_dir, "events").drop("props"), path, ["event_type"])
    return spark.read.parquet(path)


@query("partition_pruned_scan", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 3
""")
def partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_parquet(
        spark, _partitioned_orders(spark, sf_dir), ["o_orderkey", "o_totalprice"],
        (F.col("year") == 1996) & (F.col("month") == 3))


def _scattered_orders(spark: SparkSession, sf_dir: str) -> str:
    """The layout compaction is for: every task writes a file into every month."""
    path = scratch_path(spark, "orders_scattered")
    _dated_orders(spark, sf_dir).repartition(8).write.partitionBy("year", "month").parquet(path)
    return path


@query("compact_table", _DATED_SQL)
def compact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _scattered_orders(spark, sf_dir), scratch_path(spark, "orders_compact")
    layout.compact(spark, before, after, ["year", "month"], ["o_orderdate", "o_orderkey"])
    return spark.read.parquet(after)


@query("compaction_files", """
    SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(1 AS BIGINT) AS files,
           count(*) AS orders
    FROM orders GROUP BY ALL
""")
def compaction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows per month after an in-place compaction; a month of less than the target size has one file."""
    path, by = _scattered_orders(spark, sf_dir), ["year", "month"]
    layout.compact_in_place(spark, path, by, ["o_orderdate", "o_orderkey"], staging=scratch_path(spark, "compaction"))
    per_month = layout.partition_files(spark, path, by).groupBy(*[F.col(c).cast("int").alias(c) for c in by]).agg(
        F.count("*").alias("files"))
    return per_month.join(spark.read.parquet(path).groupBy(*by).agg(F.count("*").alias("orders")), by)


@query("file_layout_stats")
def file_layout_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _scattered_orders(spark, sf_dir), scratch_path(spark, "orders_compact")
    layout.compact(spark, before, after, ["year", "month"], ["o_orderdate", "o_orderkey"])
    return layout.layout_stats(spark, {"before": before, "after": after})


# ---- metrics ---------------------------------------------------------------------------------

def _quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.metric_rows(
        curation.curation_quality(table(spark, sf_dir, "documents")), stage="Curation", task="curate",
        metrics=["total_before", "total_after", "pass_ratio"])


_QUALITY_CTE = """
    q AS (SELECT CAST(count(*) AS DOUBLE) AS total_before,
                 CAST(count(DISTINCT CASE WHEN length(text) >= 100 THEN sha256(text) END) AS DOUBLE) AS total_after
          FROM documents),
    m AS (SELECT 'total_before' AS metric_name, total_before AS metric_value FROM q
          UNION ALL SELECT 'total_after', total_after FROM q
          UNION ALL SELECT 'pass_ratio', total_after / total_before FROM q)
"""


@query("metrics_log", f"""
    WITH {_QUALITY_CTE}
    SELECT 'Curation' AS stage, 'curate' AS task, 'baseline' AS phase, metric_name, metric_value FROM m
    UNION ALL
    SELECT 'ETL', 'orders', 'baseline', concat('n_', o_orderstatus), CAST(count(*) AS DOUBLE)
    FROM orders GROUP BY o_orderstatus
""")
def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics_log")
    statuses = aggregates.group_count_avg(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_totalprice")
    rows = evidence.metric_rows(statuses, stage="ETL", task="orders", metrics=["n"], label="o_orderstatus")
    for part in (_quality_metrics(spark, sf_dir), rows):
        evidence.append_metrics(evidence.log_rows(part, run_id="run"), path)
    return spark.read.parquet(path).select("stage", "task", "phase", "metric_name", "metric_value")


@query("metrics_compare", """
    WITH side AS (
        SELECT o_orderpriority AS name, CAST(count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS DOUBLE) AS base,
               CAST(count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS DOUBLE) AS other
        FROM orders GROUP BY o_orderpriority)
    SELECT 'ETL' AS stage, 'orders' AS task, concat('n_', name) AS metric_name, base, other,
           CASE WHEN base <> 0 THEN (other - base) * 100 / base END AS change_pct
    FROM side
""")
def metrics_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.count_if(~after).alias("before"), F.count_if(after).alias("n_after"))
    rows = [
        evidence.metric_rows(counts.withColumnRenamed(column, "n"), stage="ETL", task="orders", metrics=["n"],
                             phase=phase, label="o_orderpriority")
        for phase, column in (("baseline", "before"), ("optimized", "n_after"))
    ]
    return evidence.metrics_compare(rows[0].unionByName(rows[1]), base="baseline", other="optimized")


@query("slo_check", f"""
    WITH {_QUALITY_CTE},
    limits AS (SELECT * FROM (VALUES ('pass_ratio', 'min', 0.8), ('total_before', 'min', 1.0),
                                     ('total_after', 'max', 1.0), ('unreported', 'max', 1.0))
               AS t(metric_name, kind, threshold))
    SELECT metric_name, kind, CAST(threshold AS DOUBLE) AS threshold, metric_value,
           CASE WHEN metric_value IS NULL THEN 'MISSING'
                WHEN kind = 'max' AND metric_value <= threshold THEN 'PASS'
                WHEN kind = 'min' AND metric_value >= threshold THEN 'PASS' ELSE 'FAIL' END AS status
    FROM limits LEFT JOIN m USING (metric_name)
""")
def slo_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.slo_check(spark, _quality_metrics(spark, sf_dir), {
        "pass_ratio": ("min", 0.8), "total_before": ("min", 1), "total_after": ("max", 1), "unreported": ("max", 1),
    })
