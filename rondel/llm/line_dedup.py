"""Line de-duplication by an exact set-similarity join.

A line is the set of its words. Words are ordered by how rare they are in the corpus; two lines that are similar
enough share a word among the first few of that order, so only those words are joined; words that occur once in the
corpus join nothing and are left out. Meetings are cut by length, by the places of the shared word, and by 128-bit
sketches of the sets (``sketch`` and ``wide``) that bound the overlap from above. What is left is verified on the whole sets, with every word as
a 64-bit hash. Of two similar lines the later one is removed.

The lines that share a word are a run. Long runs are taken apart by classes of set size, of which only neighbours can
match, and further into blocks of which each pair is compared by itself, so that no task holds a run of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rondel.llm.shared import (
    BitFilter, WordHasher, arrow_pass, batch_of, mixed, stored, text_chunks, with_place, with_text)
from rondel.session import shuffle_width

SIMILARITY = 0.8
# Word counts are kept in a table of fixed size; words that share a cell count together, which only coarsens the order.
CELLS = 1 << 21
# Earlier partners that one task proposes per line and word; lines with more go to a second round unless settled.
PROPOSALS = 8
# Runs of one word up to this many lines are compared together, longer ones by sizes and places.
SHORT_RUN = 256
# Entries that are looked at together, besides those of a run that is not at its end.
ENTRIES = 1 << 13
# Bytes of text that are hashed at once: what is made of them stays in a processor's own cache.
CHUNK = 1 << 19
# Lines of one word that one task compares; words with more are split by set size and into blocks.
LONG_RUN = 1 << 17
# Lines, and entries, of one page at most: a batch of pages must fit beside the executor's heap.
LINES_A_PAGE, ENTRIES_A_PAGE = 64, 256
# Bytes of lines, and entries, that a task deals to pages at once, and words of lines, and entries, of one bucket, about.
DEALT_BYTES, DEALT_ENTRIES = 1 << 24, 1 << 18
BUCKET_WORDS, BUCKET_ENTRIES = 1 << 19, 1 << 16
_EPS = 1e-9
# ASCII white space, at which words are cut.
_BLANKS = " \t\n\x0b\x0c\r"


class Lines:
    """The word sets of all lines of a chunk of texts."""

    def __init__(self, hasher: WordHasher, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, _, self.hashes = hasher.words(data)
        breaks = np.flatnonzero(data == 10)
        words = np.diff(np.searchsorted(starts, breaks), prepend=0, append=len(starts))
        self.line = np.repeat(np.arange(len(words)), words)
        self.first_line = np.concatenate(([0], np.cumsum([t.count(b"\n") + 1 for t in texts])))

    def sets(self, ranks: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Distinct words by line: hashes sorted by (line, rank, hash), line bounds, and per line number, id and sketches.

        A sketch holds, for each of its cells, whether an odd number of the set's words fall there.
        """
        key = self.line if ranks is None else (self.line << 16) | ranks[_cell(self.hashes)]
        order = _by_key(key, self.hashes)
        h, line = self.hashes[order], self.line[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (line[1:] != line[:-1])
        h, line = h[keep], line[keep]
        at = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1]))) if len(line) else np.empty(0, np.int64)
        bounds = np.append(at, len(h))
        with np.errstate(over="ignore"):
            name = mixed(np.add.reduceat(mixed(h ^ np.uint64(0x5BD1E995)), at)) if len(at) else h[:0]
        bit, low = np.uint64(1) << ((h >> np.uint64(57)) & np.uint64(63)), h >> np.uint64(63) == 0
        sketch, wide = (np.bitwise_xor.reduceat(np.where(half, bit, np.uint64(0)), at) if len(at) else h[:0] for half in (low, ~low))
        return h, line, bounds, line[at], name, sketch, wide


def _by_key(key: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The order by (key, hash): one sort of the key and as many bits of the hash as there is room for, if these tell all apart."""
    room = np.uint64(int(key.max(initial=1)).bit_length())
    both = (key.astype(np.uint64) << (np.uint64(64) - room)) | (hashes >> room)
    order = np.argsort(both)
    both, h = both[order], hashes[order]
    if ((both[1:] == both[:-1]) & (h[1:] != h[:-1])).any():
        return np.lexsort((hashes, key))
    return order


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


# Cells whose counts are one row.
_PAGE = 1 << 12
_PAGES = pa.schema([("page", pa.int32()), ("data", pa.binary())])
_RANKS = pa.schema([*_PAGES, ("words", pa.int64())])


def _count_words():
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = WordHasher(CHUNK), np.zeros(CELLS, np.int64)
        held: list[np.ndarray] = []
        waiting = 0

        def pages() -> Iterator[pa.RecordBatch]:
            counts = seen.astype("<u4").reshape(-1, _PAGE)
            filled = np.flatnonzero(counts.any(axis=1))
            for i in range(0, len(filled), 64):
                part = filled[i:i + 64]
                yield batch_of(_PAGES, [part.astype(np.int32), [counts[p].tobytes() for p in part]])

        for batch in batches:
            for _, texts in text_chunks(batch.column(0).to_pylist(), CHUNK):
                held.append(_cell(hasher.words(np.frombuffer(b"\n".join(texts), np.uint8))[2]))
                waiting += len(held[-1])
                if waiting >= 2 * CELLS:
                    seen += np.bincount(np.concatenate(held), minlength=CELLS)
                    held, waiting = [], 0
                    if seen.max() >= 1 << 31:
                        yield from pages()
                        seen[:] = 0
        if held:
            seen += np.bincount(np.concatenate(held), minlength=CELLS)
        yield from pages()
    return work


def _rank_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pages of counts, those of one number one after another, the ranks of their sums, and the words of each page."""
    now, total = None, np.zeros(_PAGE, np.int64)

    def ranked() -> pa.RecordBatch:
        rank = np.minimum(np.floor(np.log2(np.maximum(total, 1)) * 1000), 65535)
        return batch_of(_RANKS, [[now], [rank.astype("<u2").tobytes()], [int(total.sum())]])

    for batch in batches:
        for page, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if page != now:
                if now is not None:
                    yield ranked()
                now, total = page, np.zeros(_PAGE, np.int64)
            total += np.frombuffer(data, "<u4")
    if now is not None:
        yield ranked()


def rarity(docs: DataFrame) -> tuple[np.ndarray, int]:
    """A rank per cell, low for rare words, from the counts of all words of all texts; 0 if it holds one word once.
    With it, how many words there are.

    A task sends its counts as pages of many cells; the driver gets the ranks, whose number is fixed beforehand.
    """
    kind = "page int, data binary"
    counts = arrow_pass(docs.select(F.col("text").cast("string")), _count_words(), kind)
    ranks = arrow_pass(counts.repartition("page").sortWithinPartitions("page"), _rank_pages, f"{kind}, words long")
    out, words = np.zeros(CELLS, "<u2"), 0
    for page, data, count in ranks.toLocalIterator():
        words += count
        out[page * _PAGE:(page + 1) * _PAGE] = np.frombuffer(data, "<u2")
    return out, words


def _prefix(n: np.ndarray, t: float) -> np.ndarray:
    return n - np.ceil(t * n - _EPS).astype(np.int64) + 1


_LINE = pa.schema([("doc_id", pa.int64()), ("file", pa.int64()), ("row", pa.int64()), ("line", pa.int32()), ("name", pa.int64()),
                   ("sketch", pa.int64()), ("wide", pa.int64()), ("n", pa.int32()), ("skip", pa.int32()),
                   ("often", pa.int32()), ("words", pa.list_(pa.int32()))])
LINE = ("doc_id long, file long, row long, line int, name long, sketch long, wide long, n int, skip int, often int, "
        "words array<int>")


def _line_sets(ranks: np.ndarray, t: float):
    """One row per line with words; ``words``: its rarest words, as 32-bit keys, as many as the prefix needs, without
    the first ``skip``, which occur nowhere else. The last ``often`` of them occur often enough for a long run."""
    frequent = int(np.log2(LONG_RUN) * 1000)
    fewest = int(np.floor(t / (1 - t) + _EPS)) if t < 1 else None  # shorter sets match equal sets only

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(CHUNK)
        for batch in batches:
            for first, texts in text_chunks(batch.column(1).to_pylist(), CHUNK):
                lines = Lines(hasher, texts)
                h, line, bounds, own, name, sketch, wide = lines.sets(ranks)
                n = np.diff(bounds)
                rank = ranks[_cell(h)]
                alone = rank == 0
                size = _prefix(n, t)
                size[n < (fewest if fewest is not None else np.iinfo(np.int64).max)] = 0
                place = np.arange(len(h)) - np.repeat(bounds[:-1], n)
                taken = place < np.repeat(size, n)
                skip = np.add.reduceat(taken & alone, bounds[:-1], dtype=np.int64) if len(n) else n
                often = np.add.reduceat(taken & (rank >= frequent), bounds[:-1], dtype=np.int64) if len(n) else n
                taken &= ~alone
                offsets = np.concatenate(([0], np.cumsum(size - skip))).astype(np.int32)
                key = (h[taken] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                words = pa.ListArray.from_arrays(pa.array(offsets), pa.array(key))
                doc = np.searchsorted(lines.first_line, own, side="right") - 1
                at = pa.array(first + doc)
                yield batch_of(_LINE, [*(batch.column(c).take(at) for c in (0, 2, 3)),
                                       (own - lines.first_line[doc]).astype(np.int32),
                                       *(c.view(np.int64) for c in (name, sketch, wide)), n.astype(np.int32), skip.astype(np.int32), often.astype(np.int32), words])
    return work


def _buckets(spark: SparkSession, rows: int, most: int) -> int:
    """So many buckets that one holds about ``most`` of the rows, and that every task gets several."""
    return max(-(-rows // most), 16 * shuffle_width(spark))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key of 32 random bits; equal keys share one."""
    return ((keys.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


def _binary(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The bytes of the numbers between each two edges."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [
        None, pa.py_buffer((edges * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _numbers(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all pages of a column, one after another."""
    column = column.cast(pa.binary())
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[edges[0]:edges[-1]].view(kind) if data is not None else np.empty(0, kind)


def _page_edges(bucket: np.ndarray, most: int) -> np.ndarray:
    """Where pages of sorted bucket numbers begin, and the end: at each new bucket, and after so many rows of one."""
    begin = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    place = np.arange(len(bucket)) - np.repeat(begin, np.diff(np.append(begin, len(bucket))))
    return np.append(np.flatnonzero(place % most == 0), len(bucket))


def _whole_buckets(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
    """Pages in the order of their buckets, in parts of whole buckets; the last column has the rows of each page.

    A part ends with the first bucket that brings it to ``least`` rows.
    """
    held: list[pa.RecordBatch] = []
    rows, now = 0, -1
    for batch in batches:
        bucket, size = batch.column(0).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
        at = 0
        for i in np.flatnonzero(np.concatenate(([now], bucket[:-1])) != bucket).tolist() if len(bucket) else []:
            rows += int(size[at:i].sum())
            held.append(batch.slice(at, i - at))
            at = i
            if rows >= least:
                yield held
                held, rows = [], 0
        if len(bucket):
            held.append(batch.slice(at))
            rows, now = rows + int(size[at:].sum()), bucket[-1]
    if rows:
        yield held


def _columns(part: list[pa.RecordBatch], kinds: list[str]) -> list[np.ndarray]:
    return [np.concatenate([_numbers(b.column(i + 1), kind) for b in part]) for i, kind in enumerate(kinds)]


# The columns of a page of lines, and the words of all its lines.
_LINE_PAGE = {"doc_id": "<i8", "known": "<i1", "file": "<i8", "row": "<i8", "line": "<i4", "name": "<i8", "sketch": "<i8", "wide": "<i8",
              "n": "<i4", "skip": "<i4", "often": "<i4", "size": "<i4", "words": "<i4"}
_ENTRY_PAGE = {"word": "<i4", "n": "<i4", "place": "<i4", "name": "<i8", "sketch": "<i8", "wide": "<i8", "doc_id": "<i8", "known": "<i1",
               "line": "<i4"}


def _page_kind(page: dict[str, str]) -> str:
    return ", ".join(["bucket int", *(f"{c} binary" for c in page), "rows int"])


def _page_batch(bucket: np.ndarray, edges: np.ndarray, columns: list[pa.Array], page: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), *columns, pa.array(np.diff(edges).astype(np.int32))],
                                      names=["bucket", *page, "rows"])


def _filled(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, 0 for null, and whether each is known."""
    return column.fill_null(0).to_numpy().astype(kind), column.is_valid().to_numpy(zero_copy_only=False).astype("<i1")


def _deal_lines(work, buckets: int):
    """The lines that ``work`` yields as pages, dealt by the names of their sets."""
    def pages(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        lines = pa.Table.from_batches(held)
        name = lines.column("name").to_numpy().view(np.uint64)
        order = np.argsort(name)
        bucket, lines = _bucket(name[order] >> np.uint64(32), buckets), lines.take(pa.array(order)).combine_chunks().to_batches()[0]
        words = lines.column("words")
        bounds = np.asarray(words.offsets) - words.offsets[0].as_py()
        doc, known = _filled(lines.column("doc_id"), "<i8")
        rest = {c: lines.column(c).to_numpy() for c in ("file", "row", "line", "name", "sketch", "wide", "n", "skip", "often")}
        rest |= {"doc_id": doc, "known": known, "size": np.diff(bounds).astype("<i4")}
        edges = _page_edges(bucket, LINES_A_PAGE)
        return _page_batch(bucket, edges, [*(_binary(rest[c], edges) for c in _LINE_PAGE if c != "words"),
                                           _binary(words.flatten().to_numpy(), bounds[edges])], _LINE_PAGE)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for lines in work(batches):
            if not lines.num_rows:
                continue
            held.append(lines)
            waiting += lines.nbytes
            if waiting >= DEALT_BYTES:
                yield pages(held)
                held, waiting = [], 0
        if held:
            yield pages(held)
    return dealt


_SETS = pa.schema([("name", pa.int64()), ("sketch", pa.int64()),
                   ("first", pa.struct([("doc_id", pa.int64()), ("line", pa.int32()), ("file", pa.int64()), ("row", pa.int64())])),
                   ("wide", pa.int64()), ("n", pa.int32()), ("skip", pa.int32()), ("often", pa.int32()), ("words", pa.list_(pa.int32()))])
SETS = ("name long, sketch long, first struct<doc_id: long, line: int, file: long, row: long>, wide long, n int, skip int, often int, "
        "words array<int>")


def _distinct_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pages of lines, those of one bucket one after another, one row per set, with its first line."""
    for part in _whole_buckets(batches, ENTRIES):
        *columns, words = _columns(part, list(_LINE_PAGE.values()))
        c = dict(zip(_LINE_PAGE, columns))
        order = np.argsort(c["name"])
        same = c["name"][order][1:] == c["name"][order][:-1]
        again = np.concatenate((same, [False])) | np.concatenate(([False], same))  # the name has several lines
        more = order[again]
        more = more[np.lexsort([c[k][more] for k in ("row", "file", "line", "doc_id", "known", "sketch", "name")])]
        new = np.ones(len(more), bool)
        new[1:] = (c["name"][more][1:] != c["name"][more][:-1]) | (c["sketch"][more][1:] != c["sketch"][more][:-1])
        at = np.concatenate((order[~again], more[new]))
        bounds = np.concatenate(([0], np.cumsum(c["size"], dtype=np.int64))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(words)).take(pa.array(at))
        first = pa.StructArray.from_arrays(
            [pa.array(c["doc_id"][at], mask=c["known"][at] == 0), *(pa.array(c[k][at]) for k in ("line", "file", "row"))],
            fields=list(_SETS.field("first").type))
        yield batch_of(_SETS, [c["name"][at], c["sketch"][at], first, *(c[k][at] for k in ("wide", "n", "skip", "often")), lists])


def _deal_entries(buckets: int):
    """An entry for each word of each set, as pages dealt by the words."""
    def pages(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sets = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        bounds = np.asarray(sets.column(0).offsets)
        word = sets.column(0).flatten().to_numpy()
        order = np.argsort(word.view(np.uint32))
        n, skip, name, sketch, wide = (c.to_numpy() for c in sets.columns[1:6])
        doc, known = _filled(sets.column(6), "<i8")
        own = np.repeat(np.arange(len(n)), np.diff(bounds))[order]
        place = (order + (skip - (bounds[:-1] - bounds[0]))[own]).astype("<i4")
        word = word[order]
        bucket = _bucket(word.view(np.uint32), buckets)
        edges = _page_edges(bucket, ENTRIES_A_PAGE)
        columns = [word, n[own], place, *(c[own] for c in (name, sketch, wide, doc, known, sets.column(7).to_numpy()))]
        return _page_batch(bucket, edges, [_binary(c, edges) for c in columns], _ENTRY_PAGE)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for batch in batches:
            words = len(batch.column(0).flatten())
            if not words:
                continue
            held.append(batch)
            waiting += words
            if waiting >= DEALT_ENTRIES:
                yield pages(held)
                held, waiting = [], 0
        if held:
            yield pages(held)
    return dealt


def _need(a, b, t: float):
    return np.ceil(t / (1 + t) * (a + b) - _EPS)


_PAIR = pa.schema([("name", pa.int64()), ("sketch", pa.int64()), ("other", pa.int64()), ("other_sketch", pa.int64()),
                   ("more", pa.bool_())])


def _order(*keys: np.ndarray) -> tuple[np.ndarray, bool]:
    """The order by the keys, the first one first, and whether neighbours agree in all: one sort, if they fit into one number."""
    both, room = np.zeros(len(keys[0]), np.uint64), 64
    for key in keys:
        low = int(key.min(initial=0))
        bits = (int(key.max(initial=0)) - low).bit_length()
        room -= bits
        if room < 0 or bits > 62:
            order = np.lexsort(keys[::-1])
            same = np.ones(max(len(order) - 1, 0), bool)
            for k in keys:
                same &= k[order][1:] == k[order][:-1]
            return order, bool(same.any())
        both = (both << np.uint64(bits)) | (key.astype(np.int64) - low).view(np.uint64)
    order = np.argsort(both)
    both = both[order]
    return order, bool((both[1:] == both[:-1]).any())


def _compare(t: float):
    """Inside runs of equal keys, from the earliest line on: for each line its first few possible partners."""
    block, width = 512, 2048

    def fits(nz: np.ndarray, pz: np.ndarray, nx: np.ndarray, px: np.ndarray) -> np.ndarray:
        """Whether sets of these sizes that first share the words at these places can be similar enough."""
        return ((np.minimum(nz, nx) >= t * np.maximum(nz, nx) - _EPS)
                & (np.minimum(nz - pz, nx - px) >= _need(nz, nx, t)))

    def close(rows: list[np.ndarray], z: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Whether the sketches leave room for enough common words, and the pair belongs to this run."""
        n, _, side, _, sketch, wide = rows
        a, b = side[z], side[x]
        apart = np.bitwise_count(sketch[z] ^ sketch[x]) + np.bitwise_count(wide[z] ^ wide[x])
        return (((n[z] + n[x] - apart) // 2 >= _need(n[z], n[x], t))
                & ((a & b & LOWER) == 0) & (((a & WITHIN) > 0) | ((a ^ b) & SECOND > 0)))

    def named(rows: list[np.ndarray], z: np.ndarray, x: np.ndarray, more: np.ndarray) -> list[np.ndarray]:
        name, sketch = (r.view(np.int64) for r in rows[3:5])
        return [name[z], sketch[z], name[x], sketch[x], more]

    def short_runs(rows: list[np.ndarray], begin: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        """All earlier partners of every line of many short runs at once."""
        # By size inside each run, so that a line meets only the shorter ones whose size fits.
        at = np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)
        number = np.repeat(np.arange(len(size)) << 32, size)
        key = number | rows[0][at]
        order = np.argsort(key)
        key, at, n = key[order], at[order], rows[0][at[order]]
        low = np.searchsorted(key, number | np.maximum(np.ceil(t * n - _EPS), 0).astype(np.int64))
        count = np.arange(len(key)) - low
        a = np.repeat(np.arange(len(key)), count)
        b = np.arange(len(a)) + np.repeat(low - np.cumsum(count) + count, count)
        left = n - rows[1][at]
        ok = np.flatnonzero(np.minimum(left[a], left[b]) >= t / (1 + t) * (n[a] + n[b]) - _EPS)
        a, b = at[a[ok]], at[b[ok]]
        z, x = np.maximum(a, b), np.minimum(a, b)
        ok = close(rows, z, x)
        z, x = z[ok], x[ok]
        order = np.lexsort((x, z))
        z, x = z[order], x[order]
        nth = np.arange(len(z)) - np.searchsorted(z, z)
        take = nth <= PROPOSALS
        return named(rows, z[take], x[take], nth[take] == PROPOSALS)

    def run(rows: list[np.ndarray]) -> list[np.ndarray] | None:
        """The same for one long run; lines of one size and place meet only those whose size and place fit."""
        kinds, kind, count = np.unique((rows[0] << 32) | rows[1], return_inverse=True, return_counts=True)
        sizes, places = kinds >> 32, kinds & 0xFFFFFFFF
        members = np.argsort(kind, kind="stable")
        begin = np.cumsum(count) - count
        out: list[tuple] = []
        for k in range(len(kinds)):
            fit = np.flatnonzero(fits(sizes[k], places[k], sizes, places))
            if not len(fit):
                continue
            mine = members[begin[k]:begin[k] + count[k]]
            others = np.sort(np.concatenate([members[begin[j]:begin[j] + count[j]] for j in fit]))
            for z0 in range(0, len(mine), block):
                z = mine[z0:z0 + block]
                found = np.zeros(len(z), np.int64)
                earlier = int(np.searchsorted(others, z[-1]))
                for x0 in range(0, earlier, width):
                    live = np.flatnonzero(found <= PROPOSALS)
                    if not len(live):
                        break
                    x = others[x0:min(x0 + width, earlier)]
                    zz = z[live]
                    a, b = np.nonzero(close(rows, zz[:, None], x[None, :]) & (x[None, :] < zz[:, None]))
                    nth = np.arange(len(a)) - np.searchsorted(a, a) + found[live][a]
                    take = nth <= PROPOSALS
                    out.append((zz[a[take]], x[b[take]], nth[take] == PROPOSALS))
                    found[live] += np.bincount(a, minlength=len(zz))
        if not out:
            return None
        return named(rows, *(np.concatenate(c) for c in zip(*out)))

    def proposals(key: np.ndarray, rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """``rows``: n, place, side, name, sketch, wide, known, doc_id and line of entries; a run has one ``key``."""
        *own, known, doc, line = rows
        order, tied = _order(key, known, doc, line)  # inside a run as by the names in _ORDER, null ids first
        if tied:
            order, _ = _order(key, known, doc, line, *(r.view(np.int64) for r in own[3:5]))
        key = key[order]
        edges = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        size = np.diff(edges)
        order, size = order[np.repeat(size > 1, size)], size[size > 1]  # a line alone meets none
        ends = np.cumsum(size)
        first = 0
        while first < len(size):
            begin = int(ends[first] - size[first])
            last = max(first + 1, int(np.searchsorted(ends, begin + ENTRIES, side="right")))
            part, counts = [r[order[begin:ends[last - 1]]] for r in own], size[first:last]
            starts, short = ends[first:last] - counts - begin, counts <= SHORT_RUN
            found = [short_runs(part, starts[short], counts[short])]
            for i in np.flatnonzero(~short):
                got = run([r[starts[i]:starts[i] + counts[i]] for r in part])
                if got is not None:
                    found.append(got)
            yield batch_of(_PAIR, [np.concatenate(c) for c in zip(*found)])
            first = last
    return proposals


def _propose_pages(t: float):
    """``_compare`` on pages of entries, those of one bucket one after another."""
    proposals = _compare(t)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_buckets(batches, ENTRIES):
            word, n, place, name, sketch, wide, doc, known, line = _columns(part, list(_ENTRY_PAGE.values()))
            hashes = [c.view(np.uint64) for c in (name, sketch, wide)]
            yield from proposals(word, [n.astype(np.int64), place.astype(np.int64), np.full(len(n), WITHIN), *hashes, known, doc, line])
    return work


def _propose(t: float):
    """``_compare`` on rows sorted by word and cell."""
    proposals = _compare(t)

    def looked_at(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        word, cell, *rest = rows
        return proposals(np.cumsum(np.concatenate(([False], (word[1:] != word[:-1]) | (cell[1:] != cell[:-1])))), rest)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []  # entries of the batches that are not yet looked at
        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(i).to_numpy().astype(np.int64) for i in range(5)]
            rows += [batch.column(i).to_numpy().view(np.uint64) for i in (5, 6, 7)]
            doc, known = _filled(batch.column(8), "<i8")
            held.append([*rows, known, doc, batch.column(9).to_numpy().astype(np.int64)])
            waiting += batch.num_rows
            if waiting < ENTRIES:
                continue
            rows = [np.concatenate(c) for c in zip(*held)]
            last = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
            cut = int(np.argmax(last))
            held, waiting = [[r[cut:] for r in rows]], 0
            if cut:
                yield from looked_at([r[:cut] for r in rows])
        if held:
            yield from looked_at([np.concatenate(c) for c in zip(*held)])
    return work


def _place_key(row: Column, line: Column) -> Column:
    """A number for a line of a document, from one for the document; ``_line_keys`` gives the same."""
    line = line.cast("long")
    return row.bitwiseXOR(line).bitwiseXOR(F.shiftleft(line, 32))


def _line_keys(row: np.ndarray, line: np.ndarray) -> np.ndarray:
    return row ^ line ^ (line << 32)


def _fetch(wanted: BitFilter):
    """The words, as 64-bit hashes, of the sets of the lines at the places asked for, with the keys of the places."""
    schema = pa.schema([("name", pa.int64()), ("sketch", pa.int64()), ("key", pa.int64()), ("set", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(CHUNK)
        for batch in batches:
            texts = [(text or "").split("\n") for text in batch.column(0).to_pylist()]
            count = np.fromiter(map(len, texts), np.int64, len(texts))
            line = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            keys = _line_keys(np.repeat(batch.column(1).to_numpy(), count), line)
            passes = wanted.passes(keys)
            keys, asked = keys[passes], compress(chain.from_iterable(texts), passes.tolist())
            for first, lines in text_chunks(list(asked), CHUNK):
                h, _, bounds, own, name, sketch, _ = Lines(hasher, lines).sets()
                sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))
                yield batch_of(schema, [name.view(np.int64), sketch.view(np.int64), keys[first + own], sets])
    return work


def _settle(pairs: DataFrame, sets: DataFrame, docs: DataFrame, t: float) -> DataFrame:
    """Of proposed pairs (later, earlier) the later sets whose words are similar enough; ``docs`` hold their first lines."""
    pairs = stored(pairs.select("name", "sketch", "other", "other_sketch").distinct(), "line-pairs")
    asked = pairs.select("name", "sketch").union(pairs.select("other", "other_sketch")).distinct()
    row = F.xxhash64("file", "row")
    places = stored(sets.select("name", "sketch", "first.file", "first.row", "first.line").join(asked, ["name", "sketch"], "left_semi")
                    .select("name", "sketch", _place_key(row, F.col("line")).alias("key")), "line-asked")
    words = arrow_pass(docs.select(F.col("text").cast("string"), row), _fetch(BitFilter(places.select("key"))),
                       "name long, sketch long, key long, set array<long>")
    # A set comes from its first line alone, so that there is no second copy to drop; a copy would only repeat pairs.
    words = stored(words.join(places, ["name", "sketch", "key"], "left_semi").drop("key"), "line-words")
    left = pairs.join(words, ["name", "sketch"])
    right = words.toDF("other", "other_sketch", "other_set")
    both = left.join(right, ["other", "other_sketch"])
    shared = F.size(F.array_intersect("set", "other_set"))
    similar = shared >= F.lit(t) * (F.size("set") + F.size("other_set") - shared) - F.lit(_EPS)
    return both.filter(similar).select("name", "sketch").distinct()


# What an entry of a run is: of the second block of two, of a block compared with itself, of the smaller class of sizes.
SECOND, WITHIN, LOWER = 1, 2, 4
_ORDER = ["doc_id", "line", "name", "sketch"]
_ENTRY = ["word", "cell", "n", "place", "side", "name", "sketch", "wide", "doc_id", "line"]


def _split_runs(entries: DataFrame, long_words: DataFrame, t: float) -> DataFrame:
    """The entries of words with long runs, dealt to cells of bounded size; every pair that can match meets in one.

    Sets whose sizes fit are in the same or in neighbouring classes, so an entry goes to its class and, as the smaller
    side, to the next one. A class with many entries is cut into blocks, and each pair of blocks is a cell.
    """
    group = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(-np.log(t))) + F.lit(_EPS)).cast("int")
    both = F.array(F.struct(group.alias("group"), F.lit(0).alias("lower")),
                   F.struct((group + 1).alias("group"), F.lit(LOWER).alias("lower")))
    dealt = (entries.join(long_words, "word", "left_semi").withColumn("to", F.explode(both))
             .select("*", "to.group", "to.lower").drop("to", "cell", "side"))
    # A class without sets of its own size has nothing to compare.
    blocks = (dealt.groupBy("word", "group").agg(F.count("*").alias("rows"), F.min("lower").alias("least"))
              .filter(F.col("least") == 0)
              .select("word", "group", F.ceil(F.col("rows") / F.lit(LONG_RUN)).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("name", "sketch"), F.col("blocks")).cast("int")
    cells = dealt.join(blocks, ["word", "group"]).withColumn("own", own)
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other").cast("long"), F.greatest("own", "other").cast("long")
    side = F.when(F.col("own") == F.col("other"), WITHIN).when(F.col("own") > F.col("other"), SECOND).otherwise(0)
    cell = F.col("group").cast("long") * (1 << 56) + low * (1 << 28) + high
    return cells.withColumn("cell", cell).withColumn("side", side + F.col("lower")).select(*entries.columns)


def _entries(sets: DataFrame) -> DataFrame:
    """An entry for each word of each set."""
    return (sets.select(F.posexplode("words").alias("at", "word"), "*")
            .select("word", F.lit(0).cast("long").alias("cell"), "n", (F.col("at") + F.col("skip")).alias("place"),
                    F.lit(WITHIN).alias("side"), "name", "sketch", "wide", F.col("first.doc_id").alias("doc_id"),
                    F.col("first.line").alias("line")))


def removed_sets(docs: DataFrame, t: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Distinct word sets with their first line, and those of them that an earlier similar set removes.

    ``docs`` has ``doc_id``, ``text`` and the place of each row, ``file`` and ``row``.
    """
    spark = docs.sparkSession
    ranks, words = rarity(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       "file", "row")
    pages = arrow_pass(rows, _deal_lines(_line_sets(ranks, t), _buckets(spark, words, BUCKET_WORDS)), _page_kind(_LINE_PAGE))
    sets = stored(arrow_pass(pages.repartition("bucket").sortWithinPartitions("bucket"), _distinct_sets, SETS), "line-sets")
    entries = _entries(sets)
    frequent = sets.filter("often > 0").select(F.explode(F.slice("words", -F.col("often"), F.col("often"))).alias("word"))
    long_words = stored(frequent.groupBy("word").count().filter(F.col("count") > LONG_RUN).select("word"), "line-long-runs")
    proposal = "name long, sketch long, other long, other_sketch long, more boolean"
    dealt, found = sets, []
    if not long_words.isEmpty():
        # Of words that may be long runs each entry goes by itself, with the others as a set of one word.
        rare = F.slice("words", F.lit(1), F.size("words") - F.col("often"))
        some = (sets.filter("often > 0").select("*", F.posexplode("words").alias("at", "word"))
                .filter(F.col("at") >= F.size("words") - F.col("often")).join(long_words, "word", "left_anti")
                .withColumn("skip", F.col("skip") + F.col("at")).withColumn("words", F.array("word")))
        dealt = sets.withColumn("words", rare).unionByName(some.select(*sets.columns))
        # By the key alone, a sort of two numbers; a task orders the entries of a run itself.
        found.append(stored(_split_runs(entries, long_words, t).select(*_ENTRY).repartition("word", "cell").sortWithinPartitions("word", "cell")
                            .mapInArrow(_propose(t), proposal), "line-proposals"))
    count = sets.agg(F.sum(F.size("words"))).first()[0] or 0
    pages = arrow_pass(dealt.select("words", "n", "skip", "name", "sketch", "wide", "first.doc_id", "first.line"),
                       _deal_entries(_buckets(spark, count, BUCKET_ENTRIES)), _page_kind(_ENTRY_PAGE))
    found.append(stored(arrow_pass(pages.repartition("bucket").sortWithinPartitions("bucket"), _propose_pages(t), proposal), "line-proposals"))
    proposed = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    gone = stored(_settle(proposed, sets, docs, t), "lines-gone")
    # Lines that have more possible partners than were proposed and are not settled meet all of them.
    open_sets = stored(proposed.filter("more").select("name", "sketch").distinct()
                       .join(gone, ["name", "sketch"], "left_anti"), "lines-open")
    if not open_sets.isEmpty():
        # Stored, so that the optimizer knows its size: the entries of few lines are broadcast, those of many are not.
        z = stored(_entries(sets.join(open_sets, ["name", "sketch"], "left_semi")), "line-open-entries")
        x = entries.toDF(*[f"x_{c}" for c in entries.columns])
        earlier = F.struct(*[F.col(f"x_{c}") for c in _ORDER]) < F.struct(*[F.col(c) for c in _ORDER])
        pairs = stored(z.join(x, F.col("word") == F.col("x_word")).filter(earlier & _may_match(t))
                       .select("name", "sketch", F.col("x_name").alias("other"), F.col("x_sketch").alias("other_sketch"),
                               F.lit(True).alias("more"))
                       .distinct(), "line-open-pairs")
        # Only the documents in which those sets come first are read again.
        asked = pairs.select("name", "sketch").union(pairs.select("other", "other_sketch")).distinct()
        places = stored(sets.join(asked, ["name", "sketch"], "left_semi").select("first.file", "first.row").distinct(),
                        "line-open-places")
        rest = _settle(pairs, sets, docs.join(places, ["file", "row"], "left_semi"), t)
        gone = stored(gone.unionByName(rest).distinct(), "lines-gone")
    return sets, gone


def _may_match(t: float) -> Column:
    n, m = F.col("n"), F.col("x_n")
    need = F.ceil(F.lit(t / (1 + t)) * (n + m) - F.lit(_EPS))
    apart = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"x_{c}"))) for c in ("sketch", "wide"))
    return ((F.least(n, m) >= F.lit(t) * F.greatest(n, m) - F.lit(_EPS))
            & (F.least(n - F.col("place"), m - F.col("x_place")) >= need)
            & (F.floor((n + m - apart) / 2) >= need))


def dedup_lines(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any others) with the lines removed from ``text`` that repeat an earlier line.

    A line repeats an earlier one if the Jaccard similarity of their sets of words (cut at ASCII white space,
    unchanged) is at least ``t``. Lines are ordered by ``doc_id`` (null first) and line number; where rows share an id,
    equal lines go by their place in the files and different ones by a fixed hash of their words. Whether an earlier
    line is itself removed does not matter.

    * Lines without words stay; they are layout. Null and empty texts stay as they are.
    * A document that loses every line stays with an empty text. A column ``n_removed`` is added by
      ``with_removals`` only; here columns are those of the input, in its order.
    * An empty table stays empty. Columns may have any names: only ``doc_id`` and ``text`` are read.
    """
    return with_text(with_removals(docs, t), docs.columns)


def with_removals(docs: DataFrame, t: float = SIMILARITY) -> DataFrame:
    """``doc`` (the input row as a struct), ``text`` with lines removed, and ``n_removed``."""
    placed = with_place(docs)
    sets, gone = removed_sets(placed.select("doc.doc_id", "doc.text", "file", "row"), t)
    # The first line of every set that is not gone; every other line with words goes.
    kept = (sets.join(gone, ["name", "sketch"], "left_anti")
            .groupBy(F.col("first.file").alias("file"), F.col("first.row").alias("row"))
            .agg(F.collect_list("first.line").alias("kept")))
    # Cut once, in a column that the next step reads more than once and so does not compute again.
    joined = placed.join(kept, ["file", "row"], "left").select(
        "doc", F.split(F.col("doc.text").cast("string"), "\n").alias("lines"),
        F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))
    blank = F.transform("lines", lambda line, i: F.when(F.ltrim(line, F.lit(_BLANKS)) == "", i))
    stay = F.array_sort(F.concat("kept", F.filter(blank, F.isnotnull)))
    return joined.select("doc", "lines", stay.alias("stay")).select(
        "doc", F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n").alias("text"),
        F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines") - F.size("stay")).cast("long").alias("n_removed"))
