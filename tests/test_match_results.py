"""The whole match-results flow on raw files made from the test tables."""

import pytest
from pyspark.sql import functions as F

from rondel.plans import match_results as matches
from rondel.plans.standins import raw_plays
from rondel.session import scratch_path
from rondel.sources import files


@pytest.fixture(scope="module")
def built(spark):
    root, raw = scratch_path(spark, "flow"), scratch_path(spark, "raw")
    files.write_csv(raw_plays(spark, "/root/testdata/sf0.001"), raw)
    log = matches.build_all(spark, raw, root, ks=(2, 3), seeds=(42, 123))
    return root, {(r["task"], r["phase"], r["metric_name"]): r["metric_value"] for r in log.collect()}


def test_counts_agree_between_layers(spark, built):
    root, metrics = built
    silver = spark.read.parquet(f"{root}/silver")
    rows = silver.count()
    assert metrics["silver_cleaning", "baseline", "row_count"] == rows
    assert metrics["match_results", "baseline", "row_count"] == rows
    assert metrics["bronze_landing", "baseline", "row_count"] > rows
    assert metrics["curate", "baseline", "total_before"] == rows
    assert metrics["team_stats", "baseline", "row_count"] == silver.select("team_1", "year").distinct().count()
    assert silver.select("match_id", "_map").distinct().count() == rows


def test_stream_reads_every_silver_row(built):
    root, metrics = built
    assert metrics["window_agg", "baseline", "input_rows"] == metrics["silver_cleaning", "baseline", "row_count"]


def test_compaction_is_logged(built):
    _, metrics = built
    assert metrics["compaction", "after", "file_count"] <= metrics["compaction", "before", "file_count"]


def test_every_table_is_written(spark, built):
    root, metrics = built
    for table in ("gold/team_stats", "gold/map_stats", "gold/match_results_compact", "gold/team_clusters",
                  "index", "curated", "features"):
        assert spark.read.parquet(f"{root}/{table}").count() > 0
    assert spark.read.parquet(f"{root}/index").count() >= metrics["build_index", "baseline", "unique_terms"]
    card = spark.read.json(f"{root}/data_card").first()
    assert card["size_rows"] == metrics["curate", "baseline", "total_after"]


def test_team_graph(spark, built):
    root, _ = built
    silver = spark.read.parquet(f"{root}/silver")
    vertices, edges = matches.team_graph(silver)
    assert edges.agg(F.sum("weight")).first()[0] == silver.filter("team_1 <> team_2").count()
    assert vertices.count() == silver.select(F.explode(F.array("team_1", "team_2"))).distinct().count()


def test_one_document_per_match_if_asked(spark, built):
    root, _ = built
    silver = spark.read.parquet(f"{root}/silver")
    assert matches.lab_corpus(silver).count() == silver.count()
    assert matches.lab_corpus(silver, ["match_id"]).count() == silver.select("match_id").distinct().count()
