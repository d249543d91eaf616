import datetime

import pytest
from pyspark.sql import functions as F

from rondel.operators import aggregates, curation, quality
from rondel.plans import match_results as matches
from rondel.sources import files

BLANK = {f.name: None for f in matches.RESULT_SCHEMA.fields}
NAMES = list(BLANK)


def raw_row(**values):
    base = dict(BLANK, date="2020-03-01", team_1="a", team_2="b", _map="dust2", result_1="16", result_2="9",
                map_winner="1", match_id="1", rank_1="3", rank_2="5", event_id="7")
    base.update(values)
    return tuple(base[n] for n in NAMES)


def raw_frame(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in NAMES))


@pytest.fixture
def bad(spark):
    return raw_frame(
        spark,
        raw_row(match_id="1", date=None),
        raw_row(match_id="2", date="01/03/2020"),
        raw_row(match_id="3", result_1="many"),
        raw_row(match_id="4", _map=None),
        raw_row(match_id="5", rank_1=None),
        raw_row(match_id="6", result_1="16", result_2="9"),
        raw_row(match_id="6", result_1="10", result_2="16"),
        raw_row(match_id="6", result_1="x"),
        raw_row(match_id="7", _map="nuke"),
        raw_row(match_id="7", _map="mirage"),
    )


def test_silver_keeps_sound_rows_only(bad):
    rows = {(r["match_id"], r["_map"]): r for r in matches.silver(bad).collect()}
    assert set(rows) == {(5, "dust2"), (6, "dust2"), (7, "nuke"), (7, "mirage")}
    assert rows[5, "dust2"]["rank_1"] is None
    assert rows[5, "dust2"]["date"] == datetime.date(2020, 3, 1)
    assert (rows[5, "dust2"]["year"], rows[5, "dust2"]["month"], rows[5, "dust2"]["score_diff"]) == (2020, 3, 7)


def test_survivor_does_not_depend_on_row_order(bad):
    kept = {matches.silver(bad.orderBy(order)).filter("match_id = 6").first()["result_1"]
            for order in (F.asc("result_1"), F.desc("result_1"))}
    assert kept == {10}


def test_contract_counts_each_rule(bad):
    report = {r["rule"]: (r["violations"], r["status"]) for r in matches.silver_contract(bad).collect()}
    assert report["date_present"] == (1, "VIOLATED")
    assert report["date_parses"] == (1, "VIOLATED")
    assert report["result_1_parses"] == (2, "VIOLATED")
    assert report["_map_present"] == (1, "VIOLATED")
    assert report["rank_1_parses"] == (0, "OK")


def test_rejects_name_the_broken_rules(bad):
    rules = matches.silver_rules()
    found = {(r["match_id"], tuple(r["reasons"])) for r in quality.rejects(bad, rules).collect()}
    assert found == {("1", ("date_present",)), ("2", ("date_parses",)), ("3", ("result_1_parses",)),
                     ("4", ("_map_present",)), ("6", ("result_1_parses",))}


def test_every_row_is_accounted_for(bad):
    row = matches.silver_balance(bad).first()
    assert row["silver_rows"] == matches.silver(bad).count() == 4
    assert row["incomplete_rows"] == quality.rejects(bad, matches.silver_rules()).count() == 5
    assert row["duplicate_rows"] == 1
    assert row["bronze_rows"] == bad.count() == 10


def test_missing_measure_breaks_the_contract(bad):
    gone = bad.withColumn("result_2", F.lit(None).cast("string"))
    report = {r["rule"]: r["violations"] for r in matches.silver_contract(gone).collect()}
    assert report["result_2_present"] == gone.count()
    assert matches.silver_balance(gone).first()["silver_rows"] == 0


def test_balance_of_an_empty_table(bad):
    assert tuple(matches.silver_balance(bad.limit(0)).first()) == (0, 0, 0, 0)


def test_hot_key_is_cut_before_the_shuffle(spark):
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"), "id")
    once = quality.keep_first(hot, ["k"], ["id"])
    assert once.count() == 2001
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")  # printed root first


@pytest.mark.parametrize("flag, winner", [(1, "a"), (2, "b"), (None, "b"), (0, "b")])
def test_winner_of_unclear_rows_is_side_two(spark, flag, winner):
    df = spark.createDataFrame([("a", "b", flag)], "team_1 string, team_2 string, map_winner int")
    row = aggregates.outcome_enrich(df, first_won=matches.first_won(), pairs={"name": ("team_1", "team_2")}).first()
    assert row["winner_name"] == winner and row["loser_name"] == ({"a", "b"} - {winner}).pop()


def test_csv_binds_by_position(spark, tmp_path):
    path = str(tmp_path / "wide")
    files.write_csv(spark.createDataFrame([(1, "x", 3.5, "")], "id int, category string, value double, text string"), path)
    full = files.read_csv_typed(spark, path, "id int, category string, value double, text string",
                                columns=["value", "id", "text"])
    assert full.first() == (3.5, 1, None)


def test_bronze_keeps_text(spark, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "bronze")
    files.write_csv(spark.createDataFrame([("007", "not a number")], "a string, b string"), source)
    assert files.land_raw(spark, source, target).first() == ("007", "not a number")


def test_weighted_mean_ignores_the_weight_of_missing_means(spark):
    df = spark.createDataFrame([("m", 10.0, 1), ("m", 20.0, 3), ("m", None, 100)], "map string, avg double, n int")
    plain = aggregates.avg_by_group(df, by="map", means={"v": "avg"}).first()["v"]
    weighted = aggregates.avg_by_group(df, by="map", means={"v": "avg"}, weight="n").first()["v"]
    assert (plain, weighted) == (15.0, 17.5)


def test_win_rate_without_decided_rows_is_null(spark):
    df = spark.createDataFrame([("m", 0, 0)], "map string, a int, b int")
    assert aggregates.win_rate_by_group(df, by="map", first="a", second="b").first()["first_win_rate"] is None


def test_first_rows_with_ties_nulls_and_repeats(spark):
    rows = [("a", 1, "x"), ("a", 1, "w"), ("a", 2, "v"), (None, 3, "u"), (None, None, "t"), ("b", 5, "s"), ("b", 5, "s"), ("c", 7, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    by_order = quality.keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, by_order.collect()), key=repr) == sorted(
        [("a", 1, "w"), (None, None, "t"), ("b", 5, "s"), ("c", 7, None)], key=repr)
    by_all = quality.keep_first(df.drop("o"), ["k"])
    assert sorted(map(tuple, by_all.collect()), key=repr) == sorted([("a", "v"), (None, "t"), ("b", "s"), ("c", None)], key=repr)
    assert quality.keep_first(df.limit(0), ["k"], ["o"]).count() == 0


def test_texts_are_not_sorted(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.range(2000).select((F.col("id") % 700).alias("g"), F.col("id").alias("doc_id"), F.repeat(F.lit("w"), 200).alias("pad")).select(
        "doc_id", F.concat("pad", F.col("g").cast("string")).alias("text")).write.parquet(path)
    kept = curation.curate_text(spark.read.parquet(path))
    plan = kept._jdf.queryExecution().executedPlan().toString().split("Union")[1]
    before_ties = plan.split("Window")[0]
    assert kept.count() == 700
    assert "ShuffledHashJoin" in before_ties and "SortMergeJoin" not in before_ties
    sorted_here = [line for line in before_ties.splitlines() if "Sort [" in line]
    assert sorted_here and all("_key" in line for line in sorted_here)  # winners: hash and order, no text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
