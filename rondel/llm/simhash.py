"""SimHash near-duplicates: fingerprints joined by walking a binary trie against itself.

Two fingerprints that differ in at most ``d`` bits agree on one of ``d + 1`` bit blocks. For each block the bits are
rotated so that the block is the top of a trie; below equal tops node pairs are walked together, differing bits
add up, and a pair of nodes is dropped once they exceed the budget. The walk starts as Spark joins: a node
with many fingerprints is replaced by the pairs of its descendants some bits further down, as often as needed,
and only then are node pairs of bounded size finished inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rondel.llm.components import components
from rondel.llm.shared import arrow_pass, batch_of, quoted, space_words, stored, with_place

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# Fingerprints of a node pair that one task finishes; larger ones are walked further by joins.
NODE_ROWS = 1024
STEP_BITS = 4


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64 majority bits over the shingle hashes; zero without words."""
    parts = space_words(text)
    parts = b" ".join(parts).lower().split(b" ") if parts else parts
    if not parts:
        return 0
    if len(parts) < words:
        shingles = [b" ".join(parts)]
    else:
        shingles = list(map(b" ".join, zip(*(parts[i:] for i in range(words)))))
    hashed = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashed), 4096):
        ones += np.unpackbits(hashed[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashed), bitorder="little").view("<u8")[0])


def _fingerprints(words: int, carried: tuple[str, ...] = ()):
    """Fingerprints of ``(doc_id, text, ...)``; further long columns are carried along."""
    schema = pa.schema([("doc_id", pa.int64()), ("bits", pa.int64()), *[(c, pa.int64()) for c in carried]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], np.uint64)
            yield batch_of(schema, [batch.column(0), bits.view(np.int64), *batch.columns[2:]])
    return work


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``bits``, a fingerprint as a signed 64-bit integer, for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_pass(rows, _fingerprints(words), "doc_id long, bits long")


def _rotated(bits, by: int):
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, 64 - by)) if by else bits


def _top(value, width: int):
    return F.shiftrightunsigned(value, 64 - width)


def walk(lo1, hi1, lo2, hi2, left, values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``(i, j)`` whose values differ in at most ``left`` of their lowest ``below`` bits.

    Each start is a pair of ranges of ``values`` that are sorted and agree above those bits; equal ranges stand for
    a node against itself. All pairs go down one bit at a time.
    """
    for bit in range(below - 1, -1, -1):
        ones = np.concatenate(([0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
        mid1, mid2 = hi1 - (ones[hi1] - ones[lo1]), hi2 - (ones[hi2] - ones[lo2])
        other = lo1 != lo2  # of a node with itself, the mixed children are one pair, not two
        lo1, hi1, lo2, hi2, left = (np.concatenate(c) for c in (
            (lo1, mid1, lo1, mid1[other]), (mid1, hi1, mid1, hi1[other]),
            (lo2, mid2, mid2, lo2[other]), (mid2, hi2, hi2, mid2[other]),
            (left, left, left - 1, left[other] - 1)))
        alive = (left >= 0) & (hi1 > lo1) & (hi2 > lo2) & ((lo1 != lo2) | (hi1 - lo1 > 1))
        lo1, hi1, lo2, hi2, left = lo1[alive], hi1[alive], lo2[alive], hi2[alive], left[alive]
    return lo1, lo2


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position that each of ``n`` positions reaches over the links ``a``-``b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _finish(most: int):
    """Links inside sorted node pairs, as a forest: no more links than fingerprints."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(rows: list[np.ndarray]) -> pa.RecordBatch:
        turn, one, two, spent, depth, side, turned, bits = rows
        keys = np.stack([turn, one, two], axis=1)
        fresh = np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))
        start = np.flatnonzero(fresh)
        end = np.append(start[1:], len(turn))
        second = np.add.reduceat(side, start) if len(start) else start
        mixed = one[start] != two[start]
        middle = end - second
        lo1, hi1 = start, np.where(mixed, middle, end)
        lo2, hi2 = np.where(mixed, middle, start), end
        values = turned.view(np.uint64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for level in np.unique(depth[start]):
            at = depth[start] == level
            ok = at & (hi1 > lo1) & (hi2 > lo2)
            found.append(walk(lo1[ok], hi1[ok], lo2[ok], hi2[ok], most - spent[start][ok], values, 64 - int(level)))
        a = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
        b = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
        if not len(a):
            return batch_of(schema, [[], []])
        # Positions of equal fingerprints in several node pairs stay apart here; components join them later.
        label = forest(len(turn), a, b)
        moved = np.flatnonzero(label != np.arange(len(turn)))
        return batch_of(schema, [bits[moved], bits[label[moved]]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            if held is not None:
                rows = [np.concatenate((h, r)) for h, r in zip(held, rows)]
            keys = rows[0], rows[1], rows[2]
            last = (keys[0] == keys[0][-1]) & (keys[1] == keys[1][-1]) & (keys[2] == keys[2][-1])
            cut = int(np.argmax(last))  # rows of the last node pair may go on in the next batch
            held = [r[cut:] for r in rows]
            if cut:
                yield links([r[:cut] for r in rows])
        if held is not None and len(held[0]):
            yield links(held)
    return work


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``(u, v)`` of distinct fingerprints ``bits``, enough to connect all that differ in at most ``max_bits`` bits."""
    edges = [round(64 * i / (max_bits + 1)) for i in range(max_bits + 2)]
    turns = []
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        turned = _rotated(F.col("bits"), a)
        turns.append(F.struct(F.lit(i).alias("turn"), _top(turned, b - a).alias("one"), _top(turned, b - a).alias("two"),
                              F.lit(0).alias("spent"), F.lit(b - a).alias("depth"), F.lit(0).alias("side"),
                              turned.alias("turned"), F.col("bits")))
    level = nodes.select(F.explode(F.array(*turns)).alias("x")).select("x.*")
    key = ["turn", "one", "two"]
    ready = []
    while True:
        level = stored(level, "trie-level")
        sizes = (level.groupBy(*key).agg(F.count("*").alias("n"), F.sum("side").alias("second"))
                 .filter("(one = two AND n > 1) OR (one <> two AND second > 0 AND second < n)"))
        sizes = stored(sizes, "trie-sizes")
        small = f"n <= {NODE_ROWS}"
        ready.append(level.join(sizes.filter(small).select(*key), key))
        if sizes.filter(f"NOT ({small})").isEmpty():
            break
        # A step may pass the last bit only where nothing is left to tell rows apart; distinct rows never get there.
        step = F.least(F.lit(STEP_BITS), 64 - F.col("depth"))
        large = level.join(sizes.filter(f"NOT ({small})").select(*key), key).withColumn("step", step)
        own = F.expr("shiftrightunsigned(turned, 64 - depth - step) & ((1L << step) - 1)")
        mates = F.expr(f"""filter(transform(sequence(0L, (1L << step) - 1), m -> named_struct('m', m,
                           'd', bit_count(m ^ own))), p -> p.d + spent <= {max_bits})""")
        pairs = (large.withColumn("own", own).withColumn("mate", F.explode(mates))
                 .withColumn("mate_d", F.col("mate.d")).withColumn("mate", F.col("mate.m")))
        same = F.col("one") == F.col("two")
        mine = F.expr("(CASE WHEN side = 0 THEN one ELSE two END << step) | own")
        theirs = F.expr("(CASE WHEN side = 0 THEN two ELSE one END << step) | mate")
        pairs = pairs.withColumn("mine", mine).withColumn("theirs", theirs)
        side = F.when(same, (F.col("mine") > F.col("theirs")).cast("int")).otherwise(F.col("side"))
        level = pairs.select(
            "turn", F.when(side == 0, F.col("mine")).otherwise(F.col("theirs")).alias("one"),
            F.when(side == 0, F.col("theirs")).otherwise(F.col("mine")).alias("two"),
            (F.col("spent") + F.col("mate_d")).cast("int").alias("spent"),
            (F.col("depth") + F.col("step")).cast("int").alias("depth"),
            side.alias("side"), "turned", "bits")
    found = []
    for part in ready:
        rows = part.select(F.col("turn").cast("long"), "one", "two", F.col("spent").cast("long"),
                           F.col("depth").cast("long"), F.col("side").cast("long"), "turned", "bits")
        dealt = rows.repartition(*key).sortWithinPartitions(*key, "side", *_unsigned("turned"))
        found.append(dealt.mapInArrow(_finish(max_bits), "u long, v long"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _unsigned(name: str) -> list:
    """Sort keys that order a signed 64-bit column as an unsigned one."""
    return [(F.col(name) < 0).asc(), F.col(name).asc()]


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``bits`` and ``component_id`` (the smallest ``doc_id`` reachable over links) for every row of ``docs``.

    * Null, empty and wordless texts have fingerprint zero and link like any other.
    * Copies share a fingerprint and are one node, so links grow with distinct fingerprints only. Rows that
      repeat an id stay rows. A null ``doc_id`` never names a component unless all its members are null.
    * An empty table gives no rows; other columns are ignored.
    """
    marked = stored(fingerprints(docs, words), "fingerprints")
    return marked.join(_classes(marked, max_bits), "bits").select("doc_id", "bits", "component_id")


def _classes(marked: DataFrame, max_bits: int) -> DataFrame:
    """Per fingerprint its component: ``bits``, ``root`` (a fingerprint) and ``component_id``; stored."""
    nodes = stored(marked.groupBy("bits").agg(F.min("doc_id").alias("least")), "fingerprint-nodes")
    roots = components(links(nodes.select("bits"), max_bits))
    grouped = nodes.join(roots, nodes["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root"))
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    return stored(grouped.join(named, "root").select("bits", "root", "component_id"), "fingerprint-classes")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay when one of each near-duplicate group does, with all their columns.

    The row with the smallest ``doc_id`` stays (null last); of several rows with that id, the first by its place in the files.
    Null and empty texts are one group.
    """
    placed = with_place(docs)
    rows = placed.select("doc.doc_id", "doc.text", "file", "row")
    marked = arrow_pass(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                                    "file", "row"), _fingerprints(words, ("file", "row")),
                        "doc_id long, bits long, file long, row long")
    marked = stored(marked, "fingerprints")
    classes = _classes(marked.select("doc_id", "bits"), max_bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row"))
    stay = (marked.join(classes.select("bits", "root"), "bits").groupBy("root").agg(first.alias("first"))
            .select("first.file", "first.row"))
    return placed.join(stay, ["file", "row"], "left_semi").select(
        *[F.col(f"doc.{quoted(c)}").alias(c) for c in docs.columns])
