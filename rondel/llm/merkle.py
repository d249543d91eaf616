"""A Merkle manifest of a table: leaves per row, a subtree per group, one root, and a proof for every row.

Rows get their rank in their group. The base-3 digits of a rank say where its leaf lies, so nodes are made by grouping the
digit columns away one after the other, last digit first; each grouping nests the structs of up to three children. That stops at
blocks of ``3 ** DIGITS`` nodes. The roots of blocks are the nodes of a next tier, built in the same way, and so on. Proofs
come from the nested structs: a transform walks one block and an explode emits its leaves with their siblings. The path above
a block reaches it by a union and a grouping on the block, so nothing is joined row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rondel.llm.shared import quoted, stored

ARITY = 3
DIGITS = 6  # of a rank that are grouped away in one block: 729 nodes at most


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(columns: list[Column]) -> Column:
    """The digest of the values: ``-`` for null, else byte count, colon, value."""
    def part(column: Column) -> Column:
        value = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*[part(c) for c in columns])


def _ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Stored ``rows`` with ``rank`` in their ``group`` (from 0, by ``order``) and the group's ``size``.

    A range partition deals even a hot group, or one repeated row, over many tasks. Places in a part are stored, and
    what lies before a part comes from one row per group and part.
    """
    keys = ["group", *order, "_place"]
    dealt = (rows.withColumn("_place", F.monotonically_increasing_id())
             .repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_place"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = stored(dealt.select("*", F.spark_partition_id().alias("part"), place.alias("place")), label)
    counts = placed.groupBy("group", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy("group")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("group").alias("_group"), F.col("part").alias("_part"),
                           (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("_shift"),
                           F.sum("n").over(group).alias("size"))
    joined = placed.join(counts, F.col("group").eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part")))
    return joined.select(*rows.columns, (F.col("place") + F.col("_shift")).alias("rank"), "size")


def _applies(level: int) -> Column:
    """Whether a group still has several nodes below ``level`` (from 1), so that this level hashes them."""
    return F.col("size") > F.lit(ARITY ** (level - 1))


def _rolled(nodes: DataFrame, below: int) -> DataFrame:
    """One row per block of nodes (``group, size, rank, hash, item``): its ``hash`` and all of it nested as ``kids``.

    ``below`` levels of the tree lie under these nodes. One shuffle by block serves all groupings.
    """
    def digit(i: int) -> Column:
        return F.expr(f"pmod(rank div {ARITY ** i}L, {ARITY}L)").cast("int").alias(f"d{i}")

    block = F.expr(f"rank div {ARITY ** DIGITS}L").alias("block")
    rows = nodes.select("group", "size", block, *[digit(i) for i in range(DIGITS)], "hash", "item")
    rows = rows.repartition("group", "block")
    nested = ["hash", "item"]
    for i in range(DIGITS):
        rest = [f"d{k}" for k in range(DIGITS - 1, i, -1)]
        kids = F.sort_array(F.collect_list(F.struct(f"d{i}", *nested))).alias("kids")
        rows = rows.groupBy("group", "size", "block", *rest).agg(kids)
        joined = F.when(_applies(below + i + 1), digest(F.array_join("kids.hash", ""))).otherwise(F.col("kids")[0]["hash"])
        rows = rows.withColumn("hash", joined)
        nested = ["hash", "kids"]
    return rows


_STEP = "struct<left:string,right:string>"


def _paths(kids: Column, level: int, below: int) -> Column:
    """The leaves under ``kids``, nodes of a block at ``level - 1``: ``item``, ``hash`` and ``path`` up to ``level``."""
    def hashes(part: Column) -> Column:
        return F.array_join(F.transform(part, lambda k: k["hash"]), "")

    def step(i: Column) -> Column:
        sides = F.struct(hashes(F.slice(kids, F.lit(1), i)).alias("left"),
                         hashes(F.slice(kids, i + 2, F.lit(ARITY))).alias("right"))
        return F.when(_applies(below + level), F.array(sides)).otherwise(F.array().cast(f"array<{_STEP}>"))

    if level == 1:
        return F.transform(kids, lambda x, i: F.struct(x["item"].alias("item"), x["hash"].alias("hash"), step(i).alias("path")))
    return F.flatten(F.transform(kids, lambda x, i: F.transform(
        _paths(x["kids"], level - 1, below),
        lambda p: F.struct(p["item"].alias("item"), p["hash"].alias("hash"), F.concat(p["path"], step(i)).alias("path")))))


def _climb(nodes: DataFrame, most: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored tiers of blocks, lowest first, and one row ``group, hash`` per group."""
    tiers, below = [], 0
    while True:
        tier = stored(_rolled(nodes, below), f"{label}-tier")
        tiers.append(tier)
        below += DIGITS
        if most <= ARITY ** below:
            return tiers, tier.select("group", "hash")
        nodes = tier.select("group", "size", F.col("block").alias("rank"), "hash", F.struct("block").alias("item"))


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows ``group, item, hash, path`` and what ``above`` carries for every node of the lowest tier.

    ``above`` has one row per block of the highest tier: ``group, block, path`` and columns to hand down.
    """
    carried = [c for c in above.columns if c not in ("group", "block", "path")]
    for i in range(len(tiers) - 1, -1, -1):
        both = tiers[i].select("group", "block", "size", "kids").unionByName(above, allowMissingColumns=True)
        whole = both.groupBy("group", "block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("size", "kids", "path", *carried)])
        leaves = whole.select("group", "path", *carried,
                              F.explode(_paths(F.col("kids"), DIGITS, i * DIGITS)).alias("leaf"))
        rows = leaves.select("group", "leaf.item", "leaf.hash", F.concat("leaf.path", "path").alias("path"), *carried)
        if i:
            above = rows.select("group", F.col("item.block").alias("block"), "path", *carried)
    return rows


def manifest(rows: DataFrame, key: str, group: str, columns: list[str], claims: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``rows``: ``key, group, leaf, claimed, subroot, root, path``.

    ``leaf`` is the digest of ``columns``; ``claimed`` is the same with the columns of ``claims`` in place of those of that name. In a
    group, leaves ascend by ``key`` (nulls first) and then by digest; every three consecutive nodes make one, until one is left,
    the ``subroot``. Subroots in the order of their group (null first, bytewise) likewise make the ``root``. ``path`` lists from
    the leaf up the digests ``left`` and ``right`` of it, joined as text; ``folded`` climbs it.

    * A null in any column is part of the digest; null groups are one group. Rows that repeat are leaves each; those
      with one key and different values are ordered by digest. An empty table gives no rows. Other columns are ignored.
    * A group of any size is dealt by range, and no block holds more than 729 nodes.
    """
    claims = claims or {}
    values = [F.col(quoted(c)) for c in columns]
    changed = [claims.get(c, F.col(quoted(c))) for c in columns]
    leaves = stored(rows.select(
        F.col(quoted(group)).cast("string").alias("group"), F.col(quoted(key)).alias("key"),
        leaf_digest(values).alias("hash"), leaf_digest(changed).alias("claimed")), "leaves")
    ranked = _ranked(leaves, ["key", "hash"], "ranked-leaves")
    nodes = ranked.select("group", "size", "rank", "hash", F.struct("key", "claimed").alias("item"))
    most = leaves.groupBy("group").count().agg(F.max("count")).first()[0] or 0
    tiers, tops = _climb(nodes, most, "leaf")

    tops = tops.select(F.lit("").alias("group"), F.col("group").alias("key"), "hash")
    ranked = _ranked(stored(tops, "subroots"), ["key"], "ranked-subroots")
    nodes = ranked.select("group", "size", "rank", "hash", F.struct("key").alias("item"))
    upper, root = _climb(nodes, tops.count(), "subroot")
    above = root.select("group", F.lit(0).cast("long").alias("block"), F.array().cast(f"array<{_STEP}>").alias("path"),
                        F.col("hash").alias("root"))
    above = _descend(upper, above).select(F.col("item.key").alias("group"), F.lit(0).cast("long").alias("block"), "path",
                                          F.col("hash").alias("subroot"), "root")
    return _descend(tiers, above).select(F.col("item.key").alias("key"), "group", F.col("hash").alias("leaf"), "item.claimed",
                                         "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda h, step: digest(step["left"], h, step["right"]))


def siblings(path: Column) -> Column:
    """All digests of ``path``, level by level and left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")
