"""Weighted graphs from two-sided result rows, and PageRank over them."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from rondel.session import cut_lineage, drop_cut, is_cut, shuffle_width

# Fewer edges than this are not worth a partition of their own: contributions are summed per partition before they are shuffled,
# and every partition of edges sends a block to every partition of ranks, in each round.
EDGES_PER_PARTITION = 1_000_000

# Most hubs whose bucket counts are broadcast; 16 bytes each.
MAX_BROADCAST_HUBS = 500_000

# Low 33 bits of monotonically_increasing_id are the position in the partition.
_POSITION_BITS = 33


def graph_pairs(df: DataFrame, first: str, second: str) -> DataFrame:
    """``low, high, weight``: rows per unordered pair of names, rows with a missing side left out.

    Everything else in the graph follows from the pairs. They are counted in the map tasks
    first, so a pair that fills a third of the table is one row per task from here on.
    """
    one, two = F.col(first).cast("string"), F.col(second).cast("string")
    return (
        df.filter(one.isNotNull() & two.isNotNull())
        .groupBy(F.least(one, two).alias("low"), F.greatest(one, two).alias("high"))
        .agg(F.count("*").alias("weight"))
    )


def graph_vertices(pairs: DataFrame) -> DataFrame:
    """``id, name``: every name once, numbered 0, 1, 2, ... in name order.

    A global ``row_number`` would sort all names in one task. Here the names are range
    partitioned, numbered inside their partition, and shifted by the size of the partitions
    before it. The numbered rows are materialised first, so both readers see the same split.
    """
    names = pairs.select(F.explode(F.array("low", "high")).alias("name")).distinct()
    placed = cut_lineage(
        names.repartitionByRange("name").sortWithinPartitions("name")
        .withColumn("_mid", F.monotonically_increasing_id())
    ).select(
        "name",
        F.shiftright("_mid", _POSITION_BITS).alias("part"),
        F.col("_mid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("position"),
    )
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    # one row per shuffle partition, so neither the window nor the broadcast grows with the data
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").select((F.col("start") + F.col("position")).alias("id"), "name")


def graph_edges(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """``src, dst, weight`` with ``src < dst``; a pair of one name with itself is no edge.

    Ids follow name order, so the lower name of a pair also has the lower id.
    """
    low = vertices.select(F.col("id").alias("src"), F.col("name").alias("low"))
    high = vertices.select(F.col("id").alias("dst"), F.col("name").alias("high"))
    return (
        pairs.filter(F.col("low") != F.col("high"))
        .join(low, "low").join(high, "high")
        .select("src", "dst", "weight")
    )


def graph_stats(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertex count, edge count, total weight and density of the undirected graph."""
    both = vertices.agg(F.count("*").alias("vertices"), F.lit(0).alias("edges"), F.lit(0).alias("weight")).unionByName(
        edges.agg(F.lit(0).alias("vertices"), F.count("*").alias("edges"), F.sum("weight").alias("weight"))
    )
    total = both.agg(*[F.sum(c).alias(c) for c in ("vertices", "edges", "weight")])
    possible = F.col("vertices").cast("double") * (F.col("vertices") - 1) / 2
    return total.withColumn("density", F.try_divide(F.col("edges").cast("double"), possible))


@dataclass
class Ranking:
    """Ranks and the per-round trace of one PageRank run."""

    ranks: DataFrame
    rounds: list[tuple[int, float, float, bool]] = field(default_factory=list)

    def trace(self, spark: SparkSession) -> DataFrame:
        """``iteration, elapsed_sec, max_delta, converged`` with the running time so far."""
        rows = spark.createDataFrame(
            self.rounds, "iteration int, elapsed_sec double, max_delta double, converged boolean")
        # one row per round
        so_far = Window.orderBy("iteration").rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("total_sec", F.sum("elapsed_sec").over(so_far))


def _oriented(edges: DataFrame, orientation: str) -> DataFrame:
    if orientation == "canonical":
        return edges
    if orientation == "both":
        return edges.select(F.explode(F.array(
            F.struct("src", "dst", "weight"),
            F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"),
        )).alias("e")).select("e.*")
    raise ValueError(f"unknown orientation {orientation!r}")


def pagerank(vertices: DataFrame, edges: DataFrame, *, damping: float = 0.85, max_rounds: int = 20,
             tol: float = 1e-4, relative: bool = False, orientation: str = "canonical",
             hub_degree: int = 1_000_000) -> Ranking:
    """Weighted PageRank, ``(1 - d) / N + d * sum(rank(u) * w(u, v) / out_weight(u))``.

    ``canonical`` sends rank from ``src`` to ``dst`` only; ``both`` uses each edge in both
    directions. The loop ends after ``max_rounds`` or once the largest change of a rank is below
    ``tol`` (of its old value, if ``relative``). Mass of vertices without out-edges is not
    redistributed.

    Layout: edges are stored once, shuffled and sorted once, and stay so for all rounds. A
    source with more than ``hub_degree`` edges has them cut into several buckets, each joined
    with its own copy of the source's rank. Per round, ranks are shuffled to the edges and the
    map-side summed contributions are shuffled back together with the old ranks, which makes the
    outer join with the vertices a part of the same aggregate. Of the rounds' ranks and shuffles only the last stay on disk.
    """
    spark = vertices.sparkSession
    # read for the out-degrees and again for the layout; also what lost cache blocks are rebuilt from
    stored = edges if is_cut(edges) else cut_lineage(edges.select("src", "dst", "weight"))
    directed = _oriented(stored, orientation)

    out = directed.groupBy(F.col("src").alias("id")).agg(
        F.sum("weight").alias("out_weight"),
        F.count("*").alias("edges"),
        F.ceil(F.count("*") / F.lit(hub_degree)).alias("buckets"),
    )
    linked = cut_lineage(vertices.select("id").join(out, "id", "left"))
    seen = linked.agg(F.count("*").alias("n"), F.sum("edges").alias("edges"),
                      F.count_if(F.col("buckets") > 1).alias("hubs")).first()
    n, hubs = seen["n"], seen["hubs"]
    linked = linked.drop("edges")

    keys = ["src", "bucket"] if hubs else ["src"]
    placed = _bucketed(directed, linked, hubs) if hubs else directed
    links = (
        placed.repartition(_width(spark, seen["edges"] or 0), *keys).sortWithinPartitions(*keys)
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    links.count()  # fills the cache, so that every round sees its partitioning and order

    base = (1.0 - damping) / n if n else 0.0
    state = linked.withColumn("rank", F.lit(1.0 / n if n else 0.0))
    result = Ranking(state)
    for number in range(1, max_rounds + 1):
        started = time.monotonic()
        change = Observation()
        old = state
        flow = _outflow(old, bool(hubs)).join(links, keys).select(
            F.col("dst").alias("id"), (F.col("share") * F.col("weight")).alias("inflow"))
        step = (
            old.select("id", "out_weight", "buckets", "rank", F.lit(0.0).alias("inflow"))
            .unionByName(flow, allowMissingColumns=True)
            .groupBy("id")
            .agg(F.max("out_weight").alias("out_weight"), F.max("buckets").alias("buckets"),
                 F.max("rank").alias("before"), F.sum("inflow").alias("inflow"))
            .filter(F.col("before").isNotNull())  # a target that is no vertex keeps no rank
            .select("id", "out_weight", "buckets", "before",
                    (F.lit(base) + F.lit(damping) * F.col("inflow")).alias("rank"))
        )
        moved = F.abs(F.col("rank") - F.col("before"))
        measured = moved / F.col("before") if relative else moved
        state = cut_lineage(step.observe(change, F.max(measured).alias("delta")).drop("before"))
        drop_cut(old)
        delta = change.get["delta"] or 0.0
        result.rounds.append((number, time.monotonic() - started, delta, delta < tol))
        if delta < tol:
            break
    links.unpersist()
    result.ranks = state.select("id", "rank")
    return result


def _width(spark: SparkSession, edges: int) -> int:
    """Partitions of the edge layout: as many as the edges ask for, and enough for the cores."""
    cores = spark.sparkContext.defaultParallelism
    return max(min(shuffle_width(spark), cores), -(-edges // EDGES_PER_PARTITION))


def _bucketed(directed: DataFrame, linked: DataFrame, hubs: int) -> DataFrame:
    """Edges with the bucket their source assigns them to; 0 for everything but hubs."""
    heavy = linked.filter(F.col("buckets") > 1).select(F.col("id").alias("src"), "buckets")
    if hubs <= MAX_BROADCAST_HUBS:  # beyond that, adaptive execution splits the skewed partitions
        heavy = F.broadcast(heavy)
    bucket = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("buckets")), F.lit(0))
    return directed.join(heavy, "src", "left").select("src", "dst", "weight", bucket.alias("bucket"))


def _outflow(state: DataFrame, bucketed: bool) -> DataFrame:
    """Rank per unit of out-weight, once for each bucket of the vertex's edges."""
    share = (F.col("rank") / F.col("out_weight")).alias("share")
    copies = [F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("buckets") - 1)).alias("bucket")] if bucketed else []
    return state.filter(F.col("buckets") > 0).select(F.col("id").alias("src"), share, *copies)


def with_names(ranks: DataFrame, vertices: DataFrame) -> DataFrame:
    return ranks.join(vertices, "id").select("id", "name", "rank")


def pagerank_top(ranks: DataFrame, vertices: DataFrame, n: int = 50, order: Column | None = None) -> DataFrame:
    """The ``n`` highest ranks with names; equal ranks are ordered by id."""
    leading = ranks.orderBy(F.desc("rank") if order is None else order, "id").limit(n)
    return with_names(leading, vertices)


def export_top(top: DataFrame, path: str, by: str = "rank", most: int = 10_000) -> None:
    """A bounded top-k as one CSV file, written by a task instead of the driver; at most ``most`` rows go into it."""
    top.orderBy(F.desc(by), "id").limit(most).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
