"""Approximate nearest neighbours: a graph built by NN-descent, searched greedily.

Equal vectors are one node. The first graph comes from sorting the nodes along random hyperplane codes, several times,
and comparing each stretch of the order with itself. Then neighbours of neighbours are compared: all that a
node lists, and some that list it, meet at that node through joins, and every one keeps the nearest it has met. That is
repeated until few lists change. A query starts at its own node and walks the graph with a beam, whose width follows from
the recall of some queries that are compared with all nodes. If no beam brings them far enough, because the graph does not
lead there, all queries are compared with all nodes, block by block.

In the walk the vectors stay where they are: nodes are dealt to blocks, queries to groups, and what moves are pages of ids
and distances. A block measures what reaches it and passes on only what is near enough for the beam.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from rondel.llm.shared import batch_of, dropped, mixed, stored

NEIGHBOURS = 16   # length of each node's list
LISTED_BY = 12    # of the nodes that list a node, so many nearest join its local comparison
ORDERS = 8        # sorted orders for the first graph
STRETCH = 384     # nodes compared with each other in one stretch of an order
CODE_BITS = 20
ROUNDS = 50       # a safety limit; reaching it is reported
CHANGED = 0.002   # stop when a smaller share of list entries changed
BEAM = 480        # the least; it doubles until the probes reach MIN_RECALL
PROBES = 64
MIN_RECALL = 0.93
NEAREST = 10
# Nodes and queries that one task of the scan compares, and the queries whose distances it holds at once.
SCAN_NODES = 1 << 14
SCAN_QUERIES = 1 << 12
SCAN_ROWS = 256
# The walk: bytes of vectors in a block of nodes, blocks at least, queries of a group and of a part (of groups that meet a
# block together), nodes that a query opens in one round, and pairs that a task spreads or measures at once.
BLOCK_BYTES = 1 << 24
BLOCKS = 64
GROUP_QUERIES = 64
PART_QUERIES = 1 << 13
OPENED = 512
PAIRS = 1 << 15
# Rows without a vector that a task sorts at once, and bytes of vectors that it holds at meeting places.
PASS_ROWS = 1 << 16
PASS_BYTES = 1 << 24

_LOG = logging.getLogger(__name__)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _numbers(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """The packed numbers of all rows of a binary column, one after the other."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column) or column.buffers()[2] is None:
        return np.empty(0, kind)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind)


def _packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary column: the numbers between each two ``edges`` as one row."""
    data = np.ascontiguousarray(values)
    ends = (edges * (data.nbytes // len(data) if len(data) else 1)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _edges(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys starts, and the end."""
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)])) if len(keys) else np.zeros(1, int)


def _dealt(ids: np.ndarray, n: int) -> np.ndarray:
    return (mixed(ids.view(np.uint64)) % np.uint64(n)).astype(np.int32)


def _sorted_by(keys: np.ndarray) -> np.ndarray:
    """The order by small numbers; numpy has a fast sort for those of 16 bits."""
    return np.argsort(keys.astype(np.uint16) if len(keys) and keys.max() < 1 << 16 else keys, kind="stable")


def _whole_runs(batches: Iterator[pa.RecordBatch], columns: Callable[[pa.RecordBatch], list[np.ndarray]], size: int,
                shorter: Callable[[list[np.ndarray]], list[np.ndarray]] | None = None) -> Iterator[list[np.ndarray]]:
    """Columns of about ``size`` rows that hold whole runs of the first column, by which the rows are sorted.

    ``shorter`` takes away what a part of a long run can't need.
    """
    held: list[list[np.ndarray]] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(columns(batch))
        n += batch.num_rows
        if n < size:
            continue
        rows = [np.concatenate(c) for c in zip(*held)]
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        if cut:
            yield [r[:cut] for r in rows]
        rest = [r[cut:].copy() for r in rows]
        held = [shorter(rest) if shorter else rest]
        n = len(held[0][0])
    if n:
        yield [np.concatenate(c) for c in zip(*held)]


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, in double precision; the same for (a, b) and (b, a)."""
    gap = a.astype(np.float64) - b.astype(np.float64)
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _closest(vectors: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs of rows, up to rounding."""
    v = vectors.astype(np.float64)
    square = np.einsum("ij,ij->i", v, v)
    return square[:, None] + square[None, :] - 2 * (v @ v.T)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``vec_id`` and ``embedding`` of the vectors that take part, and their length."""
    kind = vectors.schema["embedding"].dataType
    number = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{number}>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(
        fine & F.exists("embedding", lambda x: x != 0))
    rows = stored(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    common = (rows.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").first())
    dim = common[0] if common else 1
    return rows.filter(F.size("embedding") == dim), dim


def nodes_of(rows: DataFrame, members: int) -> DataFrame:
    """Distinct vectors: ``node`` (smallest id), ``ids`` (the ``members`` smallest) and ``embedding``; stored.

    More copies than that can never be among the nearest of anything.
    """
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= members)
    return stored(few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
                  .select(F.col("ids")[0].alias("node"), "ids", "embedding"), "nodes")


def vectors_of(nodes: DataFrame) -> DataFrame:
    """``node, vector``: packed numbers, which Spark moves as one value; stored."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.int64()), ("vector", pa.binary())])
        for batch in batches:
            yield batch_of(schema, [batch.column(0), _vector_column(batch.column(1))])

    return stored(nodes.select("node", "embedding").mapInArrow(work, "node long, vector binary"), "packed")


def _vector_column(column: pa.Array) -> pa.Array:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return _packed(values, np.arange(len(column) + 1) * (len(values) // len(column) if len(column) else 0))


def _number(rows: DataFrame) -> str:
    """The kind of numbers in ``embedding``."""
    return "<f8" if isinstance(rows.schema["embedding"].dataType.elementType, DoubleType) else "<f4"


def _codes(dim: int, orders: int, kind: str):
    schema = pa.schema([("turn", pa.int32()), ("code", pa.float64()), ("node", pa.int64()), ("vector", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(7).normal(size=(orders, dim, CODE_BITS + 1))
        for batch in batches:
            vectors = _numbers(batch.column(1), kind).reshape(-1, dim).astype(np.float64)
            for turn in range(orders):
                sides = vectors @ planes[turn]
                code = (sides[:, :-1] > 0) @ (2.0 ** np.arange(CODE_BITS - 1, -1, -1))
                near = 1 / (1 + np.exp(-sides[:, -1]))  # between equal codes, the place along one more direction
                yield batch_of(schema, [np.full(len(code), turn, np.int32), code + near, batch.column(0), batch.column(1)])
    return work


_EDGE = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("d", pa.float64()), ("fresh", pa.bool_())])
EDGE = "node long, other long, d double, fresh boolean"


def _edge(node: np.ndarray, other: np.ndarray, d: np.ndarray) -> pa.RecordBatch:
    return batch_of(_EDGE, [node, other, d, np.ones(len(node), bool)])


def _first(node: np.ndarray, other: np.ndarray, d: np.ndarray, fresh: np.ndarray, keep: int) -> np.ndarray:
    """Places of the ``keep`` nearest others of each node, in order; of two equal entries the one that isn't fresh counts."""
    order = np.lexsort((d, node))
    one, far = node[order], d[order]
    tied = np.zeros(len(order) + 1, bool)
    tied[1:-1] = (one[1:] == one[:-1]) & (far[1:] == far[:-1])
    tied = np.flatnonzero(tied[1:] | tied[:-1])
    some = order[tied]  # equal distances stand together, so only they are put in order
    order[tied] = some[np.lexsort((fresh[some], other[some], far[tied], one[tied]))]
    two = other[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    order, one = order[new], one[new]
    return order[np.arange(len(one)) - np.searchsorted(one, one) < keep]


def _compare(ids: np.ndarray, vectors: np.ndarray, keep: int) -> pa.RecordBatch:
    """The ``keep`` nearest of each row among all rows."""
    d = _closest(vectors)
    np.fill_diagonal(d, np.inf)
    k = min(keep, len(ids) - 1)
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    a, b = np.repeat(np.arange(len(ids)), k), near.ravel()
    return _edge(ids[a], ids[b], _exact(vectors[a], vectors[b]))


def _stretches(dim: int, size: int, keep: int, kind: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            rows = [batch.column(0).to_numpy(), batch.column(2).to_numpy(),
                    _numbers(batch.column(3), kind).reshape(-1, dim)]
            held = rows if held is None else [np.concatenate(c) for c in zip(held, rows)]
            while len(held[0]) >= 2 * size:  # what stays is never shorter than a stretch
                yield from part([h[:size] for h in held])
                held = [h[size:] for h in held]
        if held is not None:
            yield from part(held)

    def part(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for turn in np.unique(rows[0]):
            own = rows[0] == turn
            if own.sum() > 1:
                yield _compare(rows[1][own], rows[2][own], keep)
    return work


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [c.to_numpy(zero_copy_only=False) for c in batch.columns]


def _lists(edges: DataFrame, keep: int) -> DataFrame:
    """Of the rows ``node, other, d, fresh`` the ``keep`` nearest of each node."""
    size = PASS_ROWS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shorter(rows: list[np.ndarray]) -> list[np.ndarray]:
            at = _first(*rows, keep)
            return [r[at] for r in rows]

        for rows in _whole_runs(batches, _columns, size, shorter):
            yield batch_of(_EDGE, shorter(rows))

    return edges.repartition("node").sortWithinPartitions("node").mapInArrow(work, EDGE)


def _meeting(lists: DataFrame, most: int) -> DataFrame:
    """``node, other, listed``: what each node lists, and of those that list it about the ``most`` nearest or a few more.

    A node that very many list gets at most ``most`` of them from each stretch of a task's rows.
    """
    size = PASS_ROWS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nearest_of(held: list[list[np.ndarray]]) -> pa.RecordBatch:
            rows = [np.concatenate(c) for c in zip(*held)]
            at = _first(*rows, most)
            return batch_of(_EDGE, [r[at] for r in rows])

        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append(_columns(batch))
            if sum(len(h[0]) for h in held) >= size:
                yield nearest_of(held)
                held = []
        if held:
            yield nearest_of(held)

    back = lists.select(F.col("other").alias("node"), F.col("node").alias("other"), "d", "fresh").mapInArrow(work, EDGE)
    return (lists.withColumn("listed", F.lit(True)).unionByName(back.withColumn("listed", F.lit(False)))
            .select("node", "other", "d", "listed").repartition("node").sortWithinPartitions("node"))


def _met(most: int):
    """From runs of ``_meeting`` pairs of a node and what it lists or is listed by, each once and in order."""
    size = PASS_ROWS

    def shorter(rows: list[np.ndarray]) -> list[np.ndarray]:
        node, other, d, listed = rows
        by = np.flatnonzero(~listed)
        by = by[_first(node[by], other[by], d[by], listed[by], most)]
        at = np.concatenate([np.flatnonzero(listed), by])
        return [r[at] for r in rows]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for rows in _whole_runs(batches, _columns, size, shorter):
            node, other, _, _ = shorter(rows)
            order = np.lexsort((other, node))
            node, other = node[order], other[order]
            new = np.ones(len(node), bool)
            new[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
            yield node[new], other[new]
    return pairs


def _places(most: int):
    """Who meets at each node: itself and what ``_met`` gives."""
    schema, pairs = pa.schema([("node", pa.int64()), ("other", pa.int64())]), _met(most)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, other in pairs(batches):
            own = node[_edges(node)[:-1]]
            yield batch_of(schema, [np.concatenate([node, own]), np.concatenate([other, own])])
    return work


def _local(dim: int, keep: int, kind: str):
    """At each meeting place, sorted by it: pairs nearer than the farthest entry of the first one's list.

    A node that very many list meets others in as many places, so a batch passes on its ``keep`` nearest only.
    """
    size, many = max(1, PASS_BYTES // (8 * dim)), PAIRS

    def pairs(ids: np.ndarray, limit: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
        d = _closest(vectors)
        np.fill_diagonal(d, np.inf)
        a, b = np.nonzero(d < (limit * limit)[:, None] * (1 + 1e-9))
        return a, b

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        return [*(batch.column(i).to_numpy() for i in range(3)), _numbers(batch.column(3), kind).reshape(-1, dim)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, ids, limit, vectors in _whole_runs(batches, columns, size):
            edges = _edges(at)
            one, two = [], []
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if j - i > 1:
                    a, b = pairs(ids[i:j], limit[i:j], vectors[i:j])
                    one.append(a + i)
                    two.append(b + i)
            if one:
                a, b = np.concatenate(one), np.concatenate(two)
                far = np.concatenate([_exact(vectors[a[i:i + many]], vectors[b[i:i + many]])
                                      for i in range(0, len(a), many)] or [np.empty(0)])
                ok = far < limit[a]
                one, two, far = ids[a[ok]], ids[b[ok]], far[ok]
                # The same two nodes meet in many places; once per batch is enough.
                near = _first(one, two, far, np.ones(len(one), bool), keep)
                yield _edge(one[near], two[near], far[near])
    return work


def build_graph(vectors: DataFrame, dim: int, kind: str, keep: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """``node, other, d``: the nearest known nodes of each node; stored.

    ``vectors`` as from ``vectors_of``. An entry is ``fresh`` in the round that found it.
    """
    coded = vectors.mapInArrow(_codes(dim, ORDERS, kind), "turn int, code double, node long, vector binary")
    order = ["turn", "code", "node"]
    first = (coded.repartitionByRange(*order).sortWithinPartitions(*order)
             .mapInArrow(_stretches(dim, STRETCH, keep, kind), EDGE))
    lists = stored(_lists(first, keep), "neighbour-lists")
    for number in range(rounds):
        meets = _meeting(lists, LISTED_BY).mapInArrow(_places(LISTED_BY), "node long, other long")
        last = lists.groupBy("node").agg(F.when(F.count("*") >= keep, F.max("d")).alias("far"))
        known = vectors.join(last, "node", "left").select(
            F.col("node").alias("other"), F.coalesce("far", F.lit(float("inf"))).alias("far"), "vector")
        placed = (meets.join(known, "other").select("node", "other", "far", "vector")
                  .repartition("node").sortWithinPartitions("node"))
        better = placed.mapInArrow(_local(dim, keep, kind), EDGE)
        new = stored(_lists(better.unionByName(lists.withColumn("fresh", F.lit(False))), keep), "neighbour-lists")
        changed = new.agg(F.count_if("fresh"), F.count("*")).first()
        _LOG.info("round %d: %d of %d entries changed", number + 1, changed[0], changed[1])
        lists = new
        if not changed[1] or changed[0] < CHANGED * changed[1]:
            break
    else:
        _LOG.warning("lists still changed after %d rounds", rounds)
    return lists


@dataclass
class Blocks:
    """A graph to walk: ``vectors`` (``node, block, vector``) and ``ways`` (``node, block, ways``), packed numbers; stored."""

    vectors: DataFrame
    ways: DataFrame
    count: int
    dim: int
    kind: str


def blocks_of(vectors: DataFrame, lists: DataFrame, dim: int, kind: str) -> Blocks:
    """The graph dealt to blocks; a node leads to what it lists and to the nearest of those that list it."""
    count = max(BLOCKS, -(-vectors.count() * dim * np.dtype(kind).itemsize // BLOCK_BYTES))
    schema = pa.schema([("node", pa.int64()), ("block", pa.int32()), ("data", pa.binary())])
    pairs = _met(LISTED_BY)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of(schema, [batch.column(0), _dealt(batch.column(0).to_numpy(), count), batch.column(1)])

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, other in pairs(batches):
            edges = _edges(node)
            own = node[edges[:-1]]
            yield batch_of(schema, [own, _dealt(own, count), _packed(other, edges)])

    def kept(rows: DataFrame, work: Callable, name: str) -> DataFrame:
        return stored(rows.mapInArrow(work, f"node long, block int, {name} binary"), name)

    return Blocks(kept(vectors, dealt, "vector"), kept(_meeting(lists, LISTED_BY), ways, "ways"), count, dim, kind)


# What is stored after a round of the walk, as pages: the beams of a group (queries, nodes, distances, 1 where opened); the
# nodes to open in a block, with the queries of one part that do; the farthest distance in the beam of each query of a part.
_BEAM, _OPEN, _LIMIT = 0, 1, 2
_WALK = pa.schema([("page", pa.int32()), ("place", pa.int32()), ("part", pa.int32()), ("query", pa.binary()),
                   ("node", pa.binary()), ("d", pa.binary()), ("opened", pa.binary())])
WALK = "page int, place int, part int, query binary, node binary, d binary, opened binary"


def _settled(query: np.ndarray, node: np.ndarray, d: np.ndarray, opened: np.ndarray, beam: int, most: int, group: int,
             part: int, blocks: int) -> pa.Table:
    """Pages of a group: its beams, with the ``most`` nearest that weren't opened marked as such, and what that asks for."""
    at = _first(query, node, d, ~opened, beam)
    query, node, d, opened = query[at], node[at], d[at], opened[at]
    new = np.flatnonzero(~opened)
    new = new[np.arange(len(new)) - np.searchsorted(query[new], query[new]) < most]
    opened[new] = True
    edges = _edges(query)
    full = np.diff(edges) >= beam
    limit = np.where(full, d[edges[1:] - 1], np.inf)
    block = _dealt(node[new], blocks)
    order = _sorted_by(block)
    block, new = block[order], new[order]
    cuts = _edges(block)
    n = len(cuts) - 1

    def page(kind: int, rows: int, place: np.ndarray, columns: list) -> pa.RecordBatch:
        none = pa.nulls(rows, pa.binary())
        return batch_of(_WALK, [np.full(rows, kind, np.int32), place, np.full(rows, part, np.int32),
                                *[none if c is None else c for c in columns]])

    whole, one = np.array([0, len(query)]), np.array([0, len(limit)])
    return pa.Table.from_batches([
        page(_BEAM, 1, np.array([group], np.int32),
             [_packed(query, whole), _packed(node, whole), _packed(d, whole), _packed(opened.astype(np.uint8), whole)]),
        page(_OPEN, n, block[cuts[:-1]], [_packed(query[new], cuts), _packed(node[new], cuts), None, None]),
        page(_LIMIT, 1, np.array([part], np.int32), [_packed(query[edges[:-1]], one), None, _packed(limit, one), None]),
    ], _WALK)


def _spread(blocks: int, size: int):
    """At a block, for each query that opens a node of it, where that node leads; pages by the blocks that hold those."""
    schema = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("query", pa.binary()), ("node", pa.binary())])

    def work(key: tuple, opened: pa.Table, ways: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        query, node = _numbers(opened.column("query"), "<i8"), _numbers(opened.column("node"), "<i8")
        ids = ways.column("node").to_numpy()
        if len(ids) and len(node):
            order = np.argsort(ids)
            ids = ids[order]
            there = ids[np.minimum(np.searchsorted(ids, node), len(ids) - 1)] == node
            query, node = query[there], node[there]
            to = _numbers(ways.column("ways"), "<i8")
            sizes = ways.column("ways").combine_chunks()
            sizes = np.diff(np.frombuffer(sizes.buffers()[1], np.int32)[sizes.offset:sizes.offset + len(sizes) + 1]) // 8
            start = np.cumsum(sizes) - sizes
            for i in range(0, len(node), size):
                at = order[np.searchsorted(ids, node[i:i + size])]
                n = sizes[at]
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                other, asking = to[np.repeat(start[at], n) + inside], np.repeat(query[i:i + size], n)
                block = _dealt(other, blocks)
                by = _sorted_by(block)
                cuts = _edges(block[by])
                rows = len(cuts) - 1
                out.append(batch_of(schema, [block[by][cuts[:-1]], np.full(rows, key[1].as_py(), np.int32),
                                             _packed(asking[by], cuts), _packed(other[by], cuts)]))
        return pa.Table.from_batches(out, schema)
    return work


_VECTOR, _ASKED, _FAR = 0, 1, 2


def _not_beyond(a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Rows whose distance may be within ``limit``: all that are, and few others, in the precision of the rows."""
    if a.dtype != np.float32:
        return np.arange(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        gap = a - b
        square = np.einsum("ij,ij->i", gap, gap)
        return np.flatnonzero(~(square > limit * limit * (1 + 2e-7 * (a.shape[1] + 8)) + 1e-30) | ~np.isfinite(square))


def _measured(dim: int, kind: str, parts: int, group_size: int, size: int):
    """At a block, the distances of the nodes that queries reach, where they are small enough for the beam; pages by group."""
    schema = pa.schema([("place", pa.int32()), ("query", pa.binary()), ("node", pa.binary()), ("d", pa.binary())])

    def work(key: tuple, reached: pa.Table, held: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        query, node = _numbers(reached.column("query"), "<i8"), _numbers(reached.column("node"), "<i8")
        role, part = held.column("role").to_numpy(), key[1].as_py()

        def sorted_by_id(which: int) -> tuple[np.ndarray, np.ndarray]:
            rows = held.filter(pa.array(role == which))
            ids = rows.column("id").to_numpy()
            order = np.argsort(ids)
            return ids[order], _numbers(rows.column("data"), kind).reshape(-1, dim)[order]

        if len(query):
            nodes, vectors = sorted_by_id(_VECTOR)
            asked = sorted_by_id(_ASKED)[1]  # numbered from 0 in their part
            rows = held.filter(pa.array(role == _FAR))
            limit = np.full(len(asked), np.inf)
            limit[_numbers(rows.column("data"), "<i8")] = _numbers(rows.column("far"), "<f8")
            # A query reaches a node from many; once is enough.
            pair = np.unique(np.searchsorted(nodes, node) * len(asked) + query)
            for i in range(0, len(pair), size):
                to, of = np.divmod(pair[i:i + size], len(asked))
                near = _not_beyond(asked[of], vectors[to], limit[of])
                of, to = of[near], to[near]
                d = _exact(asked[of], vectors[to])
                near = d <= limit[of]
                q, n, d = of[near], nodes[to[near]], d[near]
                group = q // group_size
                by = _sorted_by(group)
                cuts = _edges(group[by])
                out.append(batch_of(schema, [(group[by][cuts[:-1]] * parts + part).astype(np.int32),
                                             *[_packed(c[by], cuts) for c in (q, n, d)]]))
        return pa.Table.from_batches(out, schema)
    return work


def search(queries: DataFrame, graph: Blocks, beam: int = BEAM, keep: int | None = None) -> DataFrame:
    """``query_id, node, d``: the ``keep`` (all) nearest of the ``beam`` nodes that a greedy walk finds for each query.

    ``queries``: ``query_id``, ``start`` (the node of its own vector) and ``embedding``. In each round every query opens the
    nearest nodes of its beam that it has not opened yet, at most ``OPENED``; it ends when there are none. Inside the walk a
    query is a number in its part. Only the last round's pages are kept.
    """
    total, blocks = queries.count(), graph.count
    parts = max(1, -(-total // PART_QUERIES))
    most = OPENED  # workers have a module of their own, so what they use is handed to them

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("start", pa.int64()), ("vector", pa.binary()), ("part", pa.int32())])
        for batch in batches:
            yield batch_of(schema, [batch.column(0), batch.column(1), _vector_column(batch.column(2)),
                                    _dealt(batch.column(0).to_numpy(), parts)])

    def start(key: tuple, rows: pa.Table) -> pa.Table:
        query, node, group = rows.column("query").to_numpy(), rows.column("start").to_numpy(), key[0].as_py()
        return _settled(query, node, np.zeros(len(query)), np.zeros(len(query), bool), beam, most, group, group % parts, blocks)

    def merged(key: tuple, reached: pa.Table, beams: pa.Table) -> pa.Table:
        query, node, d = (np.concatenate([_numbers(t.column(c), k) for t in (beams, reached)])
                          for c, k in (("query", "<i8"), ("node", "<i8"), ("d", "<f8")))
        opened = np.zeros(len(query), bool)
        before = _numbers(beams.column("opened"), "u1")
        opened[:len(before)] = before == 1
        group = key[0].as_py()
        return _settled(query, node, d, opened, beam, most, group, group % parts, blocks)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    none, numbered = F.lit(None), F.row_number().over(Window.partitionBy("part").orderBy("query_id")) - 1
    asked = stored(queries.select("query_id", "start", "embedding").mapInArrow(
        packed, "query_id long, start long, vector binary, part int").withColumn("query", numbered.cast("long")), "asked")
    ways = graph.ways.withColumn("part", every(parts))
    held = graph.vectors.select("block", every(parts).alias("part"), F.lit(_VECTOR).alias("role"), F.col("node").alias("id"),
                                F.col("vector").alias("data"), none.cast("binary").alias("far")).unionByName(
        asked.select(every(blocks).alias("block"), "part", F.lit(_ASKED).alias("role"), F.col("query").alias("id"),
                     F.col("vector").alias("data"), none.cast("binary").alias("far")))
    place = (F.expr(f"query div {GROUP_QUERIES}") * parts + F.col("part")).cast("int").alias("place")
    now = stored(asked.select(place, "query", "start").groupBy("place").applyInArrow(start, WALK), "walk")
    number = 0
    while not (opened := now.filter(F.col("page") == _OPEN)).isEmpty():
        number += 1
        reached = (opened.withColumnRenamed("place", "block").groupBy("block", "part").cogroup(ways.groupBy("block", "part"))
                   .applyInArrow(_spread(blocks, PAIRS), "block int, part int, query binary, node binary"))
        limits = now.filter(F.col("page") == _LIMIT).select(
            every(blocks).alias("block"), "part", F.lit(_FAR).alias("role"), none.cast("long").alias("id"),
            F.col("query").alias("data"), F.col("d").alias("far"))
        near = (reached.groupBy("block", "part").cogroup(held.unionByName(limits).groupBy("block", "part"))
                .applyInArrow(_measured(graph.dim, graph.kind, parts, GROUP_QUERIES, PAIRS),
                              "place int, query binary, node binary, d binary"))
        last, now = now, stored(near.groupBy("place").cogroup(now.filter(F.col("page") == _BEAM).groupBy("place"))
                                .applyInArrow(merged, WALK), "walk")
        dropped(last)
    _LOG.info("beam %d: %d queries walked for %d rounds", beam, total, number)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("part", pa.int32()), ("query", pa.int64()), ("node", pa.int64()), ("d", pa.float64())])
        for batch in batches:
            for i in range(batch.num_rows):
                query, node, d = (_numbers(batch.column(c + 1).slice(i, 1), k) for c, k in enumerate(("<i8", "<i8", "<f8")))
                near = np.arange(len(query)) - np.searchsorted(query, query) < (keep or beam)
                part = np.full(near.sum(), batch.column(0)[i].as_py(), np.int32)
                yield batch_of(schema, [part, query[near], node[near], d[near]])

    return (now.filter(F.col("page") == _BEAM).select("part", "query", "node", "d")
            .mapInArrow(rows, "part int, query long, node long, d double")
            .join(asked.select("part", "query", "query_id"), ["part", "query"]).select("query_id", "node", "d"))


def _scan_block(dim: int, keep: int):
    """The ``keep`` nearest nodes of a block for each query of a block."""
    schema = pa.schema([("query_id", pa.int64()), ("node", pa.int64()), ("d", pa.float64())])

    def vectors_of(rows: pa.Table, name: str) -> np.ndarray:
        return _matrix(rows.column(name).combine_chunks(), dim)

    def work(queries: pa.Table, nodes: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        if queries.num_rows and nodes.num_rows:
            asked, ids = queries.column("query_id").to_numpy(), nodes.column("node").to_numpy()
            a, b = vectors_of(queries, "asked"), vectors_of(nodes, "embedding")
            wide = b.astype(np.float64)
            square = np.einsum("ij,ij->i", wide, wide)
            k = min(keep, len(ids))
            for i in range(0, len(asked), SCAN_ROWS):
                part = a[i:i + SCAN_ROWS].astype(np.float64)
                own = np.einsum("ij,ij->i", part, part)
                d = own[:, None] + square[None, :] - 2 * (part @ wide.T)
                # These squares are rounded: all within the error of the last place are measured exactly.
                last = np.partition(d, k - 1, axis=1)[:, k - 1] + 1e-9 * (own + square.max())
                at, to = np.nonzero(d <= last[:, None])
                far = _exact(a[i + at], b[to])
                order = np.lexsort((ids[to], far, at))
                at, to, far = at[order], to[order], far[order]
                near = np.arange(len(at)) - np.searchsorted(at, at) < k
                out.append(batch_of(schema, [asked[i + at[near]], ids[to[near]], far[near]]))
        return pa.Table.from_batches(out, schema)
    return work


def scan(queries: DataFrame, nodes: DataFrame, dim: int, keep: int) -> DataFrame:
    """``query_id, node, d``: the ``keep`` nearest nodes of each query, ties to the smaller, from all nodes.

    Blocks of queries meet blocks of nodes, so a task holds one of each; a task passes on ``keep`` rows per query.
    """
    def blocks_of(rows: DataFrame, size: int) -> int:
        return -(-rows.count() // size) or 1

    n_nodes, n_queries = blocks_of(nodes, SCAN_NODES), blocks_of(queries, SCAN_QUERIES)

    def dealt(rows: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        return rows.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))))

    asked = dealt(queries.select("query_id", F.col("embedding").alias("asked")), "query_id", "part", n_queries, "block", n_nodes)
    every = dealt(nodes.select("node", "embedding"), "node", "block", n_nodes, "part", n_queries)
    found = (asked.groupBy("part", "block").cogroup(every.groupBy("part", "block"))
             .applyInArrow(_scan_block(dim, keep), "query_id long, node long, d double"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "node"))
    return found.withColumn("place", place).filter(F.col("place") <= keep).drop("place")


def _nearest_far(dim: int, probes: list, k: int):
    """The ``k`` least distances of each probe to nodes other than its own, per task."""
    schema = pa.schema([("query_id", pa.int64()), ("d", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty(0) for _ in probes]
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            for i, (_, start, asked) in enumerate(probes):
                far = np.concatenate([best[i], _exact(vectors, asked[None, :])[ids != start]])
                best[i] = np.partition(far, k - 1)[:k] if len(far) > k else far
        for (query, _, _), far in zip(probes, best):
            yield batch_of(schema, [np.full(len(far), query, np.int64), far])
    return work


def measured_beam(asked: DataFrame, nodes: DataFrame, graph: Blocks, k: int, beam: int) -> tuple[int, float]:
    """A beam by which ``PROBES`` of the queries reach ``MIN_RECALL``, and their recall; exact answers come from all nodes.

    The recall is lower only if a wider beam no longer raises it, or holds all nodes.
    """
    some = stored(asked.orderBy(F.xxhash64("query_id"), "query_id").limit(PROBES), "probes")
    probes = [(r[0], r[1], np.array(r[2])) for r in some.select("query_id", "start", "embedding").collect()]
    far = nodes.select("node", "embedding").mapInArrow(_nearest_far(graph.dim, probes, k), "query_id long, d double")
    least = F.slice(F.array_sort(F.collect_list("d")), 1, k)
    exact = stored(far.groupBy("query_id").agg(least.alias("far")), "exact").withColumn("most", F.element_at("far", -1))
    wanted = exact.agg(F.sum(F.size("far"))).first()[0]
    if not wanted:
        return beam, 1.0
    total, before = nodes.count(), -1.0
    while True:
        found = search(some, graph, beam, k + 1).join(some.select("query_id", "start"), "query_id").filter("node <> start")
        hits = (found.join(exact, "query_id").filter(F.col("d") <= F.col("most") * (1 + 1e-9)).groupBy("query_id")
                .agg(F.least(F.count("*"), F.first(F.size("far"))).alias("n")).agg(F.sum("n")).first()[0] or 0)
        recall = hits / wanted
        _LOG.info("beam %d: recall %.3f on %d queries against %d nodes", beam, recall, len(probes), total)
        if recall >= MIN_RECALL:
            return beam, recall
        if beam >= total or recall <= before:  # a wider beam finds nothing more
            _LOG.warning("recall %.3f with a beam of %d", recall, beam)
            return beam, recall
        beam, before = 2 * beam, recall


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, beam: int = BEAM) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` nearest other vectors found.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``. Score is the Euclidean distance in
    double precision on the original numbers; ties go to the smaller ``vec_id``.

    * A vector that is null, empty, zero, or holds a null or non-finite number takes no part, nor does one without id or of
      another length than most. Of several rows with one id the least vector counts.
    * Copies of a vector are one node of the graph, with as many ids as an answer could hold.
    * ``beam`` is the least width; see ``measured_beam``. Where no beam reaches ``MIN_RECALL`` the answer is exact, by ``scan``.
    * With fewer than ``k`` other vectors all are returned; an empty table gives no rows. Other columns are ignored.
    """
    rows, dim = usable(vectors)
    nodes = nodes_of(rows, k + 1)
    vectors, kind = vectors_of(nodes), _number(nodes)
    lists = build_graph(vectors, dim, kind)
    asked = stored(rows.filter(is_query).join(nodes.select(F.col("node").alias("start"), "embedding"), "embedding")
                   .select(F.col("vec_id").alias("query_id"), "start", "embedding"), "queries")
    graph = blocks_of(vectors, lists, dim, kind)
    width, recall = measured_beam(asked, nodes, graph, k, max(beam, k + 1))
    # The nearest nodes hold the nearest vectors; one of them is the query's own.
    found = search(asked, graph, width, k + 1) if recall >= MIN_RECALL else scan(asked, nodes, dim, k + 1)
    named = (found.join(nodes.select("node", F.explode("ids").alias("vec_id")), "node")
             .filter("vec_id <> query_id"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    return (named.withColumn("rank", place).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.col("d").alias("score")))
