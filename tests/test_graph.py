import glob
import time

import pytest
from pyspark.sql import functions as F

from rondel.operators import graph
from rondel.plans.catalog import QUERIES

ROWS = [("a", "b"), ("b", "a"), ("b", "c"), ("d", "d"), ("c", "c"), ("a", None)]


@pytest.fixture
def small(spark):
    pairs = graph.graph_pairs(spark.createDataFrame(ROWS, "one string, two string"), "one", "two")
    vertices = graph.graph_vertices(pairs)
    return vertices, graph.graph_edges(pairs, vertices)


def test_vertices_are_numbered_by_name(small):
    assert sorted(small[0].collect()) == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]


def test_edges_are_folded_and_without_loops(small):
    assert sorted(small[1].collect()) == [(0, 1, 2), (1, 2, 1)]


def test_stats(small):
    row = graph.graph_stats(*small).first()
    assert (row["vertices"], row["edges"], row["weight"]) == (4, 2, 3)
    assert row["density"] == pytest.approx(2 / 6)


def test_numbering_is_dense_over_many_partitions(spark):
    names = spark.range(5000).select(F.concat(F.lit("n"), F.col("id")).alias("one"), F.lit("n0").alias("two"))
    got = graph.graph_vertices(graph.graph_pairs(names, "one", "two")).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(5000))
    assert [r["name"] for r in got] == sorted(f"n{i}" for i in range(5000))


def reference_ranks(n, edges, rounds, damping=0.85):
    """The formula, written out over plain lists."""
    out = [sum(w for s, _, w in edges if s == v) for v in range(n)]
    rank = [1 / n] * n
    for _ in range(rounds):
        rank = [(1 - damping) / n + damping * sum(rank[s] * w / out[s] for s, d, w in edges if d == v)
                for v in range(n)]
    return rank


EDGES = [(0, 1, 2), (1, 2, 1), (0, 2, 5), (0, 3, 1), (2, 4, 3), (3, 4, 2)]


@pytest.mark.parametrize("orientation", ["canonical", "both"])
@pytest.mark.parametrize("hub_degree", [1_000_000, 1, 2])
def test_ranks_follow_the_formula_with_and_without_cut_hubs(spark, orientation, hub_degree):
    vertices = spark.createDataFrame([(i, f"v{i}") for i in range(6)], "id bigint, name string")
    edges = spark.createDataFrame(EDGES, "src bigint, dst bigint, weight bigint")
    run = graph.pagerank(vertices, edges, max_rounds=4, tol=0.0, orientation=orientation, hub_degree=hub_degree)
    used = EDGES + ([(d, s, w) for s, d, w in EDGES] if orientation == "both" else [])
    got = [r["rank"] for r in run.ranks.orderBy("id").collect()]
    assert got == pytest.approx(reference_ranks(6, used, 4))


def test_mass_is_kept_when_edges_run_both_ways(spark):
    vertices = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "id bigint, name string")
    edges = spark.createDataFrame(EDGES, "src bigint, dst bigint, weight bigint")
    run = graph.pagerank(vertices, edges, orientation="both")
    assert run.ranks.agg(F.sum("rank")).first()[0] == pytest.approx(1.0)


def test_loop_ends_after_the_first_quiet_round(spark):
    vertices = spark.createDataFrame([(0, "a"), (1, "b")], "id bigint, name string")
    edges = spark.createDataFrame([(0, 1, 1)], "src bigint, dst bigint, weight bigint")
    run = graph.pagerank(vertices, edges, orientation="both")
    assert [(r[0], r[3]) for r in run.rounds] == [(1, True)]
    trace = run.trace(spark).collect()
    assert trace[0]["max_delta"] == pytest.approx(0.0) and trace[0]["total_sec"] == trace[0]["elapsed_sec"]


def test_relative_tolerance(spark):
    vertices = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "id bigint, name string")
    edges = spark.createDataFrame(EDGES, "src bigint, dst bigint, weight bigint")
    loose = graph.pagerank(vertices, edges, tol=0.2, relative=False)
    tight = graph.pagerank(vertices, edges, tol=0.2, relative=True)
    assert len(loose.rounds) < len(tight.rounds)


@pytest.mark.parametrize("hub_degree", [1_000_000, 20])
def test_edges_are_neither_shuffled_nor_sorted_again(spark, monkeypatch, hub_degree):
    """In a round only the ranks and the contributions move."""
    plans = []

    def record(df, original=graph.cut_lineage):
        stored = original(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored

    monkeypatch.setattr(graph, "cut_lineage", record)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vertices = spark.range(60).select("id", F.col("id").cast("string").alias("name"))
        edges = spark.range(3000).select(
            (F.col("id") % 50).alias("src"), (F.col("id") * 7 % 60).alias("dst"), F.lit(1).alias("weight"))
        graph.pagerank(vertices, edges, max_rounds=2, tol=0.0, hub_degree=hub_degree)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    round_plan = plans[-1].split("InMemoryRelation")[0]
    assert "SortMergeJoin" in round_plan
    assert round_plan.count("Exchange hashpartitioning") == 2
    assert round_plan.count(" Sort [") == 1  # the ranks


def test_rounds_leave_nothing_behind_but_the_last(spark):
    """Shuffle files and ranks of past rounds are deleted at once; only what is still read stays on disk."""
    def checkpoints() -> set[str]:
        return set(glob.glob(spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/rdd-*"))

    def shuffles() -> set[str]:
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        roots = [str(d) for d in manager.localDirs()]
        return {f for root in roots for f in glob.glob(f"{root}/**/shuffle_*.data", recursive=True)}

    vertices = spark.range(60).select("id", F.col("id").cast("string").alias("name"))
    edges = spark.range(3000).select(
        (F.col("id") % 50).alias("src"), (F.col("id") * 7 % 60).alias("dst"), F.lit(1).alias("weight"))
    kept = []

    def run(rounds: int) -> tuple[int, int]:
        cut, files = checkpoints(), shuffles()
        kept.append(graph.pagerank(vertices, edges, max_rounds=rounds, tol=0.0))
        time.sleep(1)  # files are deleted in the background
        return len(checkpoints() - cut), len(shuffles() - files)

    graph.cut_lineage(spark.range(1))  # makes the folder
    few, many = run(2), run(12)
    # A garbage collection may take away some of either run. Each further round used to leave a checkpoint and two shuffles.
    assert many[0] <= 4 and many[1] < few[1] + 10


def test_cut_edges_are_not_stored_again(spark):
    edges = graph.cut_lineage(spark.createDataFrame(EDGES, "src bigint, dst bigint, weight bigint"))
    assert graph.is_cut(edges) and not graph.is_cut(edges.select("src", "dst"))
    graph.drop_cut(edges.select("src", "dst"))  # not what was cut, so it is left alone
    assert edges.count() == len(EDGES)


def test_top_breaks_ties_by_id_and_has_names(spark, tmp_path):
    vertices = spark.createDataFrame([(i, f"v{i}") for i in range(4)], "id bigint, name string")
    ranks = spark.createDataFrame([(0, 0.1), (1, 0.4), (2, 0.4), (3, 0.1)], "id bigint, rank double")
    top = graph.pagerank_top(ranks, vertices, 3)
    assert sorted(r["name"] for r in top.collect()) == ["v0", "v1", "v2"]
    graph.export_top(top, str(tmp_path / "top"))
    assert [r["id"] for r in spark.read.csv(str(tmp_path / "top"), header=True).collect()] == ["1", "2", "0"]


def test_relative_stop_does_not_depend_on_the_size_of_the_graph(spark):
    n = 30_000
    vertices = spark.range(n).select("id", F.col("id").cast("string").alias("name"))
    edges = spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).alias("weight"))
    absolute = graph.pagerank(vertices, edges, tol=1e-4, max_rounds=60)
    assert len(absolute.rounds) == 1  # every rank is below the tolerance from the start
    run = graph.pagerank(vertices, edges, tol=1e-2, relative=True, max_rounds=60)
    assert 10 < len(run.rounds) < 40
    rank = {r["id"]: r["rank"] * n for r in run.ranks.filter("id IN (0, 1, 29999)").collect()}
    assert rank[0] == pytest.approx(0.15) and rank[1] == pytest.approx(0.15 * 1.85)
    assert rank[29999] == pytest.approx(1.0, rel=0.1)


def test_registered_trace_goes_on_to_the_last_round_or_a_change_below_1e_9(spark, sf_dir):
    rows = QUERIES["iteration_trace"](spark, sf_dir).orderBy("iteration").collect()
    assert [r["iteration"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["converged"] for r in rows[:-1]] == [False] * (len(rows) - 1)
    assert len(rows) == 20 or rows[-1]["converged"] and rows[-1]["max_delta"] <= 1e-9


def test_edge_layout_has_a_partition_per_million_edges(spark):
    cores = spark.sparkContext.defaultParallelism
    assert graph._width(spark, 0) <= cores and graph._width(spark, 1_000_000) <= cores
    assert graph._width(spark, 432_000_000) == 432
