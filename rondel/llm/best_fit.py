"""Packing whole documents into few sequences: exact complements first, then best fit.

Only the histogram of piece lengths is packed, on the driver; it has at most one entry per length. From the longest length
down, a sequence is begun with it, and its gap is looked up among the sums of one, two and three available lengths. What fills the gap
exactly is taken as often as the counts allow, in one step. If nothing does, the longest length that still fits goes in and the
smaller gap is looked up. Lengths that cannot be part of a full sequence are placed best fit, longest first. Pieces then
find their places by their ranks among the pieces of their length.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame

from rondel.llm.packing import SEQUENCE_IDS, pieces, place

END_ID = 1

Pattern = tuple[tuple[int, ...], int]


class Complements:
    """Available lengths, and which sums of one, two and three of them there are."""

    def __init__(self, counts: dict[int, int], most: int):
        self.most = most
        self.count = np.zeros(most + 1, np.int64)
        for length, n in counts.items():
            self.count[length] = n
        # Pairs of different lengths by their sum; twice the same length is looked up in the counts.
        self.pairs = np.zeros(2 * most + 1, np.int64)
        held = np.flatnonzero(self.count)
        for i, x in enumerate(held.tolist()):
            self.pairs[x + held[i + 1:]] += 1

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if n and self.count[length] == 0:
            others = np.flatnonzero(self.count)
            self.pairs[length + others] -= 1

    def longest(self, most: int) -> int:
        """The longest available length of at most ``most``; 0 if there is none."""
        held = np.flatnonzero(self.count[:most + 1])
        return int(held[-1]) if len(held) else 0

    def _pair(self, total: int, but: int = 0) -> tuple[int, ...]:
        """Two available lengths of this sum, the longer one as long as possible; one ``but`` is spoken for."""
        if total < 2:
            return ()
        long = np.arange(min(total - 1, self.most), (total - 1) // 2, -1)
        short = total - long
        need_long, need_short = 1 + (long == but) + (long == short), 1 + (short == but) + (long == short)
        fits = np.flatnonzero((self.count[long] >= need_long) & (self.count[short] >= need_short))
        return (int(long[fits[0]]), int(short[fits[0]])) if len(fits) else ()

    def _pair_may_be(self, totals: np.ndarray) -> np.ndarray:
        half = totals // 2
        twice = (totals % 2 == 0) & (self.count[half] >= 2)
        return (self.pairs[totals] > 0) | twice

    def filling(self, gap: int) -> tuple[int, ...]:
        """One, two or three available lengths, longest first, that fill ``gap`` exactly; empty if none do."""
        if gap <= self.most and self.count[gap]:
            return (gap,)
        found = self._pair(gap) if self._pair_may_be(np.array([gap]))[0] else ()
        if found:
            return found
        # of three lengths the longest is at least a third, so the other two are at most two thirds
        first = np.arange(min(gap - 2, self.most), (gap + 2) // 3 - 1, -1)
        first = first[self.count[first] > 0] if len(first) else first
        for x in first[self._pair_may_be(gap - first)].tolist() if len(first) else []:
            found = self._pair(gap - x, x)
            if found:
                return tuple(sorted((x, *found), reverse=True))
        return ()


def exact_fills(counts: dict[int, int], most: int) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns of full sequences, and the counts of the lengths that are left."""
    held = Complements(counts, most)
    patterns: list[Pattern] = []
    left: dict[int, int] = {}
    for length in sorted(counts, reverse=True):
        while held.count[length]:
            inside, gap, fill = [length], most - length, ()
            held.count[length] -= 1  # spoken for while its complement is looked up
            taken = [length]
            while gap:
                fill = held.filling(gap)
                if fill:
                    break
                more = held.longest(gap)
                if not more:
                    break
                inside.append(more)
                held.count[more] -= 1
                taken.append(more)
                gap -= more
            for x in taken:
                held.count[x] += 1
            if gap and not fill:
                left[length] = int(held.count[length])
                held.take(length, left[length])
                break
            inside = sorted((*inside, *fill), reverse=True)
            n = min(int(held.count[x]) // inside.count(x) for x in set(inside))
            for x in set(inside):
                held.take(x, n * inside.count(x))
            patterns.append((tuple(inside), n))
    return patterns, left


def best_fit(counts: dict[int, int], most: int) -> list[Pattern]:
    """Patterns of the lengths by best fit, longest first; equal sequences are one entry with a count."""
    gaps: list[int] = []  # ascending, of the open sequences
    open_: dict[int, list[Pattern]] = {}

    def put(gap: int, lengths: tuple[int, ...], n: int) -> None:
        if gap not in open_:
            bisect.insort(gaps, gap)
            open_[gap] = []
        open_[gap].append((lengths, n))

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            at = bisect.bisect_left(gaps, length)
            gap = gaps[at] if at < len(gaps) else most
            lengths, n = ((), todo) if gap == most else open_[gap].pop()
            if gap != most and not open_[gap]:
                del open_[gap], gaps[at]
            # the gap that is left is the smallest again as long as it fits, so one sequence takes all it can
            each = min(gap // length, todo)
            used = min(n, todo // each)
            if gap != most and used < n:
                put(gap, lengths, n - used)
            put(gap - each * length, lengths + (length,) * each, used)
            todo -= used * each
    return [p for gap in gaps for p in open_[gap]]


def pack_exact(counts: dict[int, int], most: int = SEQUENCE_IDS) -> list[Pattern]:
    """Patterns (lengths from longest to shortest) with how many sequences follow each: exact fills, then best fit."""
    patterns, left = exact_fills({k: n for k, n in counts.items() if n}, most)
    return patterns + best_fit(left, most)


def pack(docs: DataFrame, vocabulary: str, sequence_ids: int = SEQUENCE_IDS, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every text of ``docs`` (``doc_id``, ``text``) with its place in a sequence.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A text with its end id is one piece, unless it is
    longer than a sequence; then it is cut into full sequences and a rest.

    * Null and empty texts are one piece of one id. Null and repeated ids are packed row by row. An empty
      table gives no piece. Other columns are ignored.
    * Ranks come from counts per task and length, so no length or document may grow a task.
    """
    return place(pieces(docs, vocabulary, sequence_ids, end_id), sequence_ids, packer=pack_exact)
