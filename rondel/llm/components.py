"""Connected components of a graph given as pairs, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rondel.llm.shared import stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least neighbour: those above the node (large), or the node and those below (small)."""
    if large:
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(both)
    joined = both.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:
        moved = joined.select("v", "m").union(least.select("u", "m")).toDF("u", "v")
    return moved.filter("u <> v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``pairs (u, v)`` but the roots; a root is the least node of its component.

    A star with very many leaves is joined, never collected, and its minima are combined before the shuffle. Each
    round is stored on the shared folder; the end is reached when a round changes nothing.
    """
    now = stored(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), "pairs")
    state = None
    while True:
        now = stored(_star(_star(now, large=True), large=False), "stars")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
