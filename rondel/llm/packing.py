"""Packing token ids into sequences by shortest-pack-first over the histogram of lengths.

A document is cut into pieces of one full sequence each and a rest. Only the histogram of piece lengths, which
has at most one entry per length, is packed, on the driver: lengths are placed longest first, each into the fitting
packs with the least filled, and whole groups of equal packs move at once. A pack pattern is a list of lengths with a count.
Every piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rondel.llm.shared import arrow_pass, batch_of, stored
from rondel.llm.tokens import opened

SEQUENCE_IDS = 4096
END_ID = 2


def _pieces(path: str, end_id: int, most: int):
    schema = pa.schema([("task", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("place", pa.int64()), ("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task = opened(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seen = np.zeros(most + 1, np.int64)  # pieces of each length so far in this task
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for key, got in zip(batch.column(0).to_pylist(), words.encode(batch.column(1).to_pylist())):
                data = got + end
                total = len(data) // 4
                for start in range(0, total, most):
                    piece = data[4 * start:4 * (start + most)]
                    length = len(piece) // 4
                    for column, value in zip(out, (task, key, start, length, zlib.crc32(piece), total,
                                                   int(seen[length]), piece)):
                        column.append(value)
                    seen[length] += 1
            yield batch_of(schema, out)
    return work


def pieces(docs: DataFrame, vocabulary: str, sequence_ids: int = SEQUENCE_IDS, end_id: int = END_ID) -> DataFrame:
    """Token ids of every whole text with an end id, cut into pieces of at most ``sequence_ids``, and stored.

    ``task`` and ``place`` (the number of pieces of this length before it in its task) are stored with
    the ids, so ranks never change when a task is repeated.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(arrow_pass(rows, _pieces(vocabulary, end_id, sequence_ids),
                             "task long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                             "place long, ids binary"), "pieces")


def pack_histogram(counts: dict[int, int], most: int = SEQUENCE_IDS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths from longest to shortest) with how many sequences follow each.

    Longest lengths first; of the packs with room the least filled ones take a length. Packs with
    equal contents are one entry with a count, which is split when only some of them are taken. At most two
    entries arise per length and entry touched, whatever the number of documents.
    """
    open_packs: list[tuple[int, int, tuple[int, ...], int]] = []  # filled, tie-break, lengths, count
    done: list[tuple[tuple[int, ...], int]] = []
    shortest = min(counts, default=1)
    serial = 0

    def put(lengths: tuple[int, ...], filled: int, count: int) -> None:
        nonlocal serial
        if most - filled < shortest:
            done.append((lengths, count))
            return
        serial += 1
        heapq.heappush(open_packs, (filled, serial, lengths, count))

    for length in sorted(counts, reverse=True):
        left, fresh = counts[length], []
        while left:
            if open_packs and open_packs[0][0] + length <= most:
                filled, _, lengths, count = heapq.heappop(open_packs)
                used = min(left, count)
                if used < count:
                    put(lengths, filled, count - used)
                # as many as fit go into one pack before the next pack is opened
                more = min((most - filled) // length, max(1, left // used))
                fresh.append((lengths + (length,) * more, filled + more * length, used))
                left -= used * more
            else:
                each = min(most // length, left)
                full = left // each
                fresh.append(((length,) * each, each * length, full))
                left -= full * each
        for lengths, filled, count in fresh:
            put(lengths, filled, count)
    return done + [(lengths, count) for _, _, lengths, count in open_packs]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, first sequence and offset of each run of equal slots, by rank."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            runs.setdefault(length, []).append((rank, sequence, offset))
            used[length] = rank + count
            offset += length
        sequence += count
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def _place(slots: dict[int, tuple[np.ndarray, ...]], names: list[str], kinds: pa.Schema):
    schema = kinds.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            edges = np.flatnonzero(np.diff(length[order])) + 1
            for at in np.split(order, edges) if len(order) else []:
                first, base, offsets = slots[int(length[at[0]])]
                run = np.searchsorted(first, rank[at], side="right") - 1
                sequence[at] = base[run] + rank[at] - first[run]
                offset[at] = offsets[run]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield batch_of(schema, [*columns, sequence, offset])
    return work


def place(cut: DataFrame, sequence_ids: int = SEQUENCE_IDS, keep: tuple[str, ...] = (
        "doc_id", "start", "length", "ids_crc32", "doc_tokens"), packer=pack_histogram) -> DataFrame:
    """``sequence_id`` and ``offset`` of each of the stored ``pieces``; ``packer`` turns the histogram into patterns.

    A piece's rank is its place in its task plus the pieces of that length in earlier tasks. The patterns sent to
    the tasks are bounded by the sequence length, not by the number of documents.
    """
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = stored(counts, "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}
    slots = _slots(packer(histogram, sequence_ids))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.select("task", "place", *keep).join(before, ["task", "length"]).select(
        *keep, (F.col("before") + F.col("place")).alias("rank"))
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = ranked.select(*keep)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return ranked.mapInArrow(_place(slots, list(keep), to_arrow_schema(kept.schema)),
                             columns + ", sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, sequence_ids: int = SEQUENCE_IDS, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every text of ``docs`` (``doc_id``, ``text``), with its place in a sequence.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    * Null and empty texts are one piece of one id. Null and repeated ids are packed row by row. An empty
      table gives no piece. Other columns are ignored.
    * No length or document may grow a task: ranks come from counts per task, never from one sorted group.
    """
    return place(pieces(docs, vocabulary, sequence_ids, end_id), sequence_ids)


def sequences(cut: DataFrame, sequence_ids: int = SEQUENCE_IDS, pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids``, ``used``.

    Each is padded to ``sequence_ids``, except where what is used is a power of two and so a usual shape already.
    """
    placed = place(cut, sequence_ids, ("ids", "length"))
    joined = placed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length", "ids"))).alias("parts"),
        F.sum("length").alias("used"))

    schema = pa.schema([("sequence_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("used", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for parts, used in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = np.frombuffer(b"".join(p["ids"] for p in parts), "<u4").tolist()
                rows.append(ids if used & (used - 1) == 0 else ids + [pad_id] * (sequence_ids - used))
            yield batch_of(schema, [batch.column(0), rows, batch.column(2)])

    return joined.mapInArrow(work, "sequence_id long, ids array<long>, used long")
