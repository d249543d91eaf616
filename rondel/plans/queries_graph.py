"""Queries over the contact and delivery graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rondel.operators import graph
from rondel.plans.registry import SQL, query
from rondel.plans.standins import CONTACTS_SQL, DELIVERIES_SQL, contacts, deliveries
from rondel.session import cut_lineage, drop_cut, scratch_path
from rondel.sources import files

_DAMPING = 0.85
_ROUNDS = 20


def _graph_ctes(pairs: str) -> str:
    return f"""
    v AS (SELECT row_number() OVER (ORDER BY name) - 1 AS id, name
          FROM (SELECT one AS name FROM {pairs} UNION SELECT two FROM {pairs}) AS names WHERE name IS NOT NULL),
    e AS (SELECT a.id AS src, b.id AS dst, count(*) AS weight
          FROM (SELECT least(one, two) AS low, greatest(one, two) AS high FROM {pairs}
                WHERE one IS NOT NULL AND two IS NOT NULL AND one <> two) AS folded
          JOIN v AS a ON a.name = low JOIN v AS b ON b.name = high GROUP BY a.id, b.id)"""


def _pagerank_ctes(pairs: str, rounds: int, both: bool) -> str:
    """A fixed number of rounds as a chain of common table expressions."""
    directed = "SELECT src, dst, weight FROM e" + (" UNION ALL SELECT dst, src, weight FROM e" if both else "")
    parts = [
        _graph_ctes(pairs),
        f"d AS MATERIALIZED ({directed})",
        "o AS MATERIALIZED (SELECT src, CAST(sum(weight) AS DOUBLE) AS out_weight FROM d GROUP BY src)",
        "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT count(*) FROM v) AS rank FROM v)",
    ]
    for i in range(1, rounds + 1):
        parts.append(f"""
    r{i} AS MATERIALIZED (
        SELECT v.id, (1 - {_DAMPING}::DOUBLE) / (SELECT count(*) FROM v) + {_DAMPING}::DOUBLE * coalesce(c.inflow, 0) AS rank
        FROM v LEFT JOIN (SELECT d.dst AS id, sum(p.rank * d.weight / o.out_weight) AS inflow
                          FROM d JOIN r{i - 1} AS p ON p.id = d.src JOIN o ON o.src = d.src GROUP BY d.dst) AS c
        ON c.id = v.id)""")
    return "WITH " + ",".join(parts)


def _graph(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges; the counted pairs are stored once, read for both and deleted once the edges are stored."""
    pairs = cut_lineage(graph.graph_pairs(rows, "one", "two"))
    vertices = graph.graph_vertices(pairs)
    edges = cut_lineage(graph.graph_edges(pairs, vertices))
    drop_cut(pairs)
    return vertices, edges


def _contact_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _graph(contacts(spark, sf_dir))


@query("graph_vertices", f"WITH {_graph_ctes(DELIVERIES_SQL)} SELECT id, name FROM v")
def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_vertices(graph.graph_pairs(deliveries(spark, sf_dir), "one", "two"))


@query("graph_edges", f"WITH {_graph_ctes(CONTACTS_SQL)} SELECT src, dst, weight FROM e")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _contact_graph(spark, sf_dir)[1]


@query("graph_stats", f"""
    WITH {_graph_ctes(CONTACTS_SQL)},
    s AS (SELECT (SELECT count(*) FROM v) AS vertices, count(*) AS edges, CAST(sum(weight) AS BIGINT) AS weight FROM e)
    SELECT vertices, edges, weight,
           CAST(edges AS DOUBLE) / (CAST(vertices AS DOUBLE) * (vertices - 1) / 2) AS density FROM s
""")
def graph_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_stats(*_contact_graph(spark, sf_dir))


def _in_shares(ranks: DataFrame, vertices: DataFrame) -> DataFrame:
    """Ranks as multiples of 1/N, which tell them apart at any size; the last digits of sums depend on the order of rows."""
    n = vertices.agg(F.count("*")).scalar()
    return ranks.select("id", "name", F.round(F.col("rank") * n, 6).alias("rank_shares"))


_SHARES = "id, name, round(rank * (SELECT count(*) FROM v), 6) AS rank_shares"


@query("pagerank", f"""
    {_pagerank_ctes(CONTACTS_SQL, _ROUNDS, both=False)}
    SELECT {_SHARES} FROM r{_ROUNDS} JOIN v USING (id)
""")
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, edges = _contact_graph(spark, sf_dir)
    run = graph.pagerank(vertices, edges, damping=_DAMPING, max_rounds=_ROUNDS, tol=0.0)
    return _in_shares(graph.with_names(run.ranks, vertices), vertices)


def _converged_sql(rounds: int, tol: float) -> str:
    """Every round up to the limit, of which the first quiet one is taken."""
    deltas = " UNION ALL ".join(
        f"SELECT {i} AS i, (SELECT max(abs(a.rank - b.rank) / b.rank) FROM r{i} AS a JOIN r{i - 1} AS b USING (id)) AS delta"
        for i in range(1, rounds + 1))
    every = " UNION ALL ".join(f"SELECT {i} AS i, id, rank FROM r{i}" for i in range(1, rounds + 1))
    return f"""
    {_pagerank_ctes(CONTACTS_SQL, rounds, both=False)},
    t AS MATERIALIZED ({deltas}),
    stop AS (SELECT coalesce(min(i) FILTER (WHERE delta < {tol}), {rounds}) AS i FROM t)
    SELECT {_SHARES} FROM ({every}) AS every_round JOIN stop USING (i) JOIN v USING (id)"""


# The largest change of a rank relative to its old value, so the size of the graph does not decide when to stop.
_TOL = 1e-3


@query("pagerank_converged", _converged_sql(_ROUNDS, _TOL))
def pagerank_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 20 rounds, ended by the largest relative change of a rank."""
    vertices, edges = _contact_graph(spark, sf_dir)
    run = graph.pagerank(vertices, edges, damping=_DAMPING, max_rounds=_ROUNDS, tol=_TOL, relative=True)
    return _in_shares(graph.with_names(run.ranks, vertices), vertices)


@query("pagerank_both", f"""
    {_pagerank_ctes(DELIVERIES_SQL, _ROUNDS, both=True)}
    SELECT {_SHARES} FROM r{_ROUNDS} JOIN v USING (id)
""")
def pagerank_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, edges = _graph(deliveries(spark, sf_dir))
    run = graph.pagerank(vertices, edges, damping=_DAMPING, max_rounds=_ROUNDS, tol=0.0, orientation="both")
    return _in_shares(graph.with_names(run.ranks, vertices), vertices)


@query("pagerank_top", f"""
    {_pagerank_ctes(CONTACTS_SQL, _ROUNDS, both=False)}
    SELECT {_SHARES} FROM r{_ROUNDS} JOIN v USING (id)
    ORDER BY round(rank * (SELECT count(*) FROM v), 6) DESC, id LIMIT 50
""")
def pagerank_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    vertices, edges = _contact_graph(spark, sf_dir)
    run = graph.pagerank(vertices, edges, damping=_DAMPING, max_rounds=_ROUNDS, tol=0.0)
    # A rank is about 1/N, so ranks are told apart as multiples of that, at any size of the graph.
    leading = F.desc(F.round(F.col("rank") * vertices.count(), 6))
    return _in_shares(graph.pagerank_top(run.ranks, vertices, 50, order=leading), vertices)


@query("pagerank_top_export", SQL["pagerank_top"])
def pagerank_top_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading vertices as one CSV file, read back."""
    path = scratch_path(spark, "pagerank_top")
    graph.export_top(pagerank_top(spark, sf_dir), path, by="rank_shares")
    return files.read_csv_typed(spark, path, "id bigint, name string, rank_shares double")


# The trace follows the ranks down to this relative change; a rank is below 1, so no round is missing that an absolute stop would have.
_TRACE_TOL = 1e-9


def _trace_sql() -> str:
    deltas = " UNION ALL ".join(
        f"SELECT {i} AS iteration, (SELECT max(abs(a.rank - b.rank) / b.rank) FROM r{i} AS a "
        f"JOIN r{i - 1} AS b USING (id)) AS delta" for i in range(1, _ROUNDS + 1))
    return f"""
    {_pagerank_ctes(CONTACTS_SQL, _ROUNDS, both=False)},
    t AS MATERIALIZED ({deltas})
    SELECT CAST(iteration AS INT) AS iteration, round(delta, 9) AS max_delta, delta < {_TRACE_TOL} AS converged FROM t
    WHERE iteration <= coalesce((SELECT min(iteration) FROM t WHERE delta < {_TRACE_TOL}), {_ROUNDS})"""


@query("iteration_trace", _trace_sql())
def iteration_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reproducible columns; the full trace also has the time of each round and its running total."""
    run = graph.pagerank(*_contact_graph(spark, sf_dir), damping=_DAMPING, max_rounds=_ROUNDS, tol=_TRACE_TOL, relative=True)
    return run.trace(spark).select("iteration", F.round("max_delta", 9).alias("max_delta"), "converged")
