"""The test tables read in the shape of match results, events and two-sided rows.

A line item plays the part of one map of a match: its order is the match, its line number the
map, its part and supplier the two sides. ``(l_orderkey, l_linenumber)`` is not unique in the
data, so the natural key really has copies. Each stand-in has a Spark and an SQL form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rondel.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column expressions valid in both engines; money and rates become whole numbers, so that
# sums and means do not depend on the order of rows.
_PLAY_COLUMNS = {
    "date": "CAST(l_shipdate AS DATE)",
    "team_1": "concat('p', CAST(l_partkey AS VARCHAR(20)))",
    "team_2": "concat('s', CAST(l_suppkey AS VARCHAR(20)))",
    "_map": "concat('map_', CAST(l_linenumber AS VARCHAR(20)))",
    "result_1": "CAST(l_quantity AS INT)",
    "result_2": "CAST(round(l_discount * 100) AS INT)",
    "map_winner": "CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 END",
    "starting_ct": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END",
    "ct_1": "CAST(l_quantity AS INT)",
    "t_2": "CAST(round(l_discount * 100) AS INT)",
    "t_1": "CAST(round(l_tax * 100) AS INT)",
    "ct_2": "CAST(l_linenumber AS INT)",
    "event_id": "CAST(l_suppkey AS INT)",
    "match_id": "l_orderkey",
    "rank_1": "NULLIF(CAST(l_linenumber AS INT), 7)",
    "rank_2": "CAST(round(l_tax * 100) AS INT)",
    "map_wins_1": "CAST(l_linenumber AS INT)",
    "map_wins_2": "CAST(round(l_tax * 100) AS INT)",
    "match_winner": "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END",
}
_DERIVED = {"year": "CAST(year(date) AS INT)", "month": "CAST(month(date) AS INT)", "score_diff": "abs(result_1 - result_2)"}


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


PLAYS_SQL = f"(SELECT *, {_listed(_DERIVED)} FROM (SELECT {_listed(_PLAY_COLUMNS)} FROM lineitem) AS p0) AS plays"

# What a raw file would hold: everything as text, with gaps and unreadable numbers where the
# source has a zero discount, the top tax rate, or a quantity of 50.
_DIRTY = {"date": "CASE WHEN result_2 > 0 THEN CAST(date AS VARCHAR(20)) END",
          "result_1": "CASE WHEN result_1 < 50 THEN CAST(result_1 AS VARCHAR(20)) END",
          "result_2": "CASE WHEN rank_2 = 8 THEN 'n/a' ELSE CAST(result_2 AS VARCHAR(20)) END"}
RAW_COLUMNS = {c: _DIRTY.get(c, f"CAST({c} AS VARCHAR(20))") for c in _PLAY_COLUMNS}


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = spread(table(spark, sf_dir, "lineitem")).selectExpr(*[f"{e} AS {n}" for n, e in _PLAY_COLUMNS.items()])
    return typed.selectExpr("*", *[f"{e} AS {n}" for n, e in _DERIVED.items()])


def raw_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = spread(table(spark, sf_dir, "lineitem")).selectExpr(*[f"{e} AS {n}" for n, e in _PLAY_COLUMNS.items()])
    return typed.selectExpr(*[f"CAST({e} AS STRING) AS {n}" for n, e in RAW_COLUMNS.items()])


_EVENT_COLUMNS = {
    "event_timestamp": "ts",
    "map": "event_type",
    "_map": "event_type",
    "result_1": "CAST(round(value * 100) AS INT)",
    "result_2": "CAST(user_id AS INT)",
    "score_diff": "CAST(round(value * 100) AS INT)",
    "map_winner": "CASE WHEN value < 20 THEN 1 WHEN value < 40 THEN 2 END",
    "rank_1": "CAST(user_id AS INT)",
}
_K = r"""TRY_CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INT)"""
_EVENT_COLUMNS["rank_2"] = _K

EVENTS_SQL = f"(SELECT event_id, {_listed(_EVENT_COLUMNS)} FROM events) AS ev"


def match_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns of both event streams; the event time has no zone."""
    return table(spark, sf_dir, "events").selectExpr("event_id", *[f"{e} AS {n}" for n, e in _EVENT_COLUMNS.items()])


# One row per event between two users: the acting one and the one in its properties.
CONTACTS_SQL = (
    f"(SELECT concat('u', CAST(user_id AS VARCHAR(20))) AS one, concat('u', CAST({_K} AS VARCHAR(20))) AS two "
    "FROM events) AS contacts"
)


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("one"),
        F.concat(F.lit("u"), F.expr(_K).cast("string")).alias("two"),
    )


# One row per line between the customer who ordered it and the supplier who shipped it.
DELIVERIES_SQL = (
    "(SELECT concat('c', CAST(o_custkey AS VARCHAR(20))) AS one, concat('s', CAST(l_suppkey AS VARCHAR(20))) AS two "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS deliveries"
)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, "o_orderkey").select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("one"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("two"),
    )
