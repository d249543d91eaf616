"""Alignment of the tokens of two tokenizers over the bytes of the same texts.

A text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B). Where a token of each ends at the same
byte, the text can be cut. Cuts are found by divide and conquer: near the middle of an interval of A tokens a common end is
looked for by bisecting B's ends, and both halves are treated alike; an interval without a common end is a leaf and stays one
group. The intervals of all texts of a block are worked on together, level by level, as arrays.

Each cut links the two tokens that end there. How often a pair of ids is linked in the whole corpus is counted with
a combine per block; a block then asks for the counts of its distinct pairs, never for one row per link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rondel.llm.shared import arrow_pass, batch_of, stored
from rondel.llm.tokens import SIGN_BEHIND_LETTER, PartCache, Runs, WordCache, flat, masked, ragged, spans

BLOCK_TOKENS = 1 << 17  # A tokens of one block of texts; a longer text is a block of its own
ENCODED_AT_ONCE = 1 << 20  # characters; a longer text is encoded alone
CACHE_WORDS = 50_000    # with the ids of both vocabularies
CACHE_STEMS = 250_000


class Pieces:
    """Ids of words by the piece vocabulary.

    No piece holds a space behind another sign and none a line break, so texts may be cut into words (``by_word``). If none
    holds a sign behind a letter either, these may be told apart (``by_part``).
    """

    # Runs of spaces are pieces of their own; so is a space that the library puts before a line break.
    SPACING = "  | \n|▁|^[ \n]| $"

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        self.by_word = not any("▁" in p.lstrip("▁") or "\n" in p for p in names)
        self.by_part = not any(SIGN_BEHIND_LETTER.search(p) for p in names)
        self.line = np.array(self.library.encode("\n")[1:], "<u4")

    def word_ids(self, words: list[str], before: str) -> Runs:
        if before:  # the library puts the space there itself
            return flat(self.library.encode(words, num_threads=1))
        drop = 1 + len(self.line)
        return flat([ids[drop:] for ids in self.library.encode(["\n" + w for w in words], num_threads=1)])

    stem_ids = word_ids

    def whole(self, column: pa.Array) -> np.ndarray:
        """The texts that the library reads whole."""
        return masked(pc.match_substring_regex(column, self.SPACING)) | (not self.by_word)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def entry_bytes(cache: WordCache) -> list[bytes]:
    """The bytes of every entry of a byte-level vocabulary, by id."""
    of = byte_letters()
    out = [b""] * cache.library.get_vocab_size()
    for entry, i in cache.library.get_vocab().items():
        out[i] = bytes(of[c] for c in entry) if all(c in of for c in entry) else entry.encode()
    return out


def shared_ends(a: np.ndarray, b: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of the ascending ends ``a`` occur among the ascending ends ``b``, as a mask.

    ``last`` are the places in ``a`` of the ends of the texts, known to be common. Every interval between known cuts looks near
    its middle, in rings that double: the nearest common end cuts it in two; an interval without one is done.
    """
    cut = np.zeros(len(a), bool)
    cut[last] = True
    low, high = np.concatenate(([0], last[:-1] + 1)), last.copy()
    some = low < high
    low, high = low[some], high[some]
    while len(low):
        middle = (low + high) // 2
        found = np.full(len(low), -1, np.int64)
        looking, inner, outer = np.arange(len(low)), 0, 1
        while len(looking):
            # places at distance inner .. outer - 1 from the middle, nearest first
            away = np.repeat(np.arange(inner, outer), 2)
            away[::2] *= -1
            at = middle[looking, None] + away
            valid = (at >= low[looking, None]) & (at < high[looking, None])
            ends = a[np.where(valid, at, 0)]
            place = np.searchsorted(b, ends)
            valid &= b[np.minimum(place, len(b) - 1)] == ends
            hit = valid.any(axis=1)
            found[looking[hit]] = at[hit, valid[hit].argmax(axis=1)]
            rest = looking[~hit]
            looking = rest[(middle[rest] - outer >= low[rest]) | (middle[rest] + outer < high[rest])]
            inner, outer = outer, 2 * outer
        some = found >= 0
        low, high, found = low[some], high[some], found[some]
        cut[found] = True
        low, high = np.concatenate([low, found + 1]), np.concatenate([found, high])
        some = low < high
        low, high = low[some], high[some]
        order = np.argsort(low)
        low, high = low[order], high[order]
    return cut


class Aligner:
    """Aligns blocks of texts; one per worker process and pair of vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = WordCache(path_a, plain=True), Pieces(path_b)
        # A keeps spaces, as B does, so both are given the same parts of words; each part is looked up once.
        self.parts = PartCache([self.a, self.b], CACHE_STEMS, CACHE_WORDS, by_part=self.b.by_part)
        self.bytes_a, self.bytes_b = entry_bytes(self.a), self.b.bytes
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.spelled = [(np.frombuffer(b"".join(x), np.uint8), np.cumsum(n) - n, n)
                        for x, n in ((self.bytes_a, self.sizes_a), (self.bytes_b, self.sizes_b))]
        self.kind = "<u4" if len(self.bytes_a) * len(self.bytes_b) < 1 << 32 else "<u8"
        # What a group is written with: an id and the sign behind it.
        self.signs = np.array([f"{i}{s}".encode() for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;"))
                               for i in range(n) for s in ends], object)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both vocabularies per text; none where either does not give back the text's bytes."""
        given = [t or "" for t in texts]
        column = pa.array(given, pa.string())
        alone = self.a.whole(given, column) | self.b.whole(column)
        cut = column.filter(pa.array(~alone & masked(pc.not_equal(column, ""))))
        runs = self.parts.gathered(pc.replace_substring(cut, "\n", " \n"))
        found = zip(*([ids[s:e] for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist())] for ids, bounds in runs))
        none = np.empty(0, np.int64)
        out = []
        for text, apart in zip(given, alone.tolist()):
            if not text:
                out.append((none, none))
                continue
            both = (np.array(self.a.library.encode(" " + text, add_special_tokens=False).ids, "<u4"),
                    np.array(self.b.library.encode(text), "<u4")) if apart else next(found)
            x, y = (ids.astype(np.int64) for ids in both)
            whole = (" " + text).encode("utf-8", "surrogatepass")
            same = all(signs[ragged(starts[ids], sizes[ids])].tobytes() == whole
                       for (signs, starts, sizes), ids in zip(self.spelled, (x, y)))
            out.append((x, y) if same else (none, none))
        return out

    def block(self, ids: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[int], list[bytes]]:
        """Linked pairs in order, as numbers, how many of them each text has, and each text's groups as text."""
        a, b = (np.concatenate([x[i] for x in ids]) if ids else np.empty(0, np.int64) for i in (0, 1))
        n_a, n_b = (np.array([len(x[i]) for x in ids], np.int64) for i in (0, 1))
        if not len(a):
            return np.empty(0, self.kind), [0] * len(ids), [b""] * len(ids)
        ends_a, ends_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        cut = shared_ends(ends_a, ends_b, np.cumsum(n_a)[n_a > 0] - 1)
        at_a = np.flatnonzero(cut)
        at_b = np.searchsorted(ends_b, ends_a[at_a])
        links = a[at_a] * len(self.bytes_b) + b[at_b]

        cut_b = np.zeros(len(b), bool)
        cut_b[at_b] = True
        group_a, group_b = np.cumsum(cut) - cut, np.cumsum(cut_b) - cut_b
        written = np.empty(len(a) + len(b), np.int64)
        written[np.arange(len(a)) + np.concatenate(([0], at_b + 1))[group_a]] = 2 * a + cut
        written[np.arange(len(b)) + (at_a + 1)[group_b]] = 2 * (len(self.bytes_a) + b) + cut_b
        edges = np.concatenate(([0], np.cumsum(n_a + n_b)))
        groups = [b"".join(self.signs[written[s:e]].tolist())[:-1] for s, e in zip(edges[:-1], edges[1:])]
        per_text = np.diff(np.concatenate(([0], np.cumsum(cut)))[np.concatenate(([0], np.cumsum(n_a)))])
        return links.astype(self.kind), per_text.tolist(), groups


_OPEN: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _OPEN:
        _OPEN[path_a, path_b] = Aligner(path_a, path_b)
    return _OPEN[path_a, path_b]


_BLOCK = pa.schema([("task", pa.int32()), ("block", pa.int32()), ("doc_id", pa.list_(pa.int64())),
                    ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())),
                    ("groups", pa.list_(pa.string())), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())),
                    ("times", pa.list_(pa.int64()))])
BLOCK = ("task int, block int, doc_id array<long>, n_a array<long>, n_b array<long>, n_links array<long>, "
         "groups array<string>, links binary, pairs array<long>, times array<long>")


def _blocks(path_a: str, path_b: str, digest: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task = aligner(path_a, path_b), TaskContext.get().partitionId()
        number, held, keys, ids = 0, 0, [], []

        def close() -> pa.RecordBatch:
            links, n_links, groups = both.block(ids)
            said = [hashlib.sha256(g).hexdigest() if digest and g else g.decode() for g in groups]
            pairs, times = np.unique(links, return_counts=True)
            return batch_of(_BLOCK, [[task], [number], [list(keys)], [[len(x) for x, _ in ids]], [[len(y) for _, y in ids]],
                                     [n_links], [said], [links.tobytes()], [pairs.astype(np.int64)], [times.astype(np.int64)]])

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s, e in spans(texts, ENCODED_AT_ONCE):
                for key, got in zip(names[s:e], both.encode(texts[s:e])):
                    keys.append(key)
                    ids.append(got)
                    held += len(got[0])
                    if held >= BLOCK_TOKENS:
                        yield close()
                        number, held, keys, ids = number + 1, 0, [], []
        if keys:
            yield close()
    return work


def aligned(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, digest: bool = False) -> DataFrame:
    """Texts of ``docs`` (``doc_id``, ``text``) aligned and stored, one row per block of texts.

    A block holds per text ``doc_id, n_a, n_b, n_links, groups`` (``a1,a2|b1;a3|b2,b3``; ``digest`` gives its sha256 instead, empty
    where there are no tokens), all linked pairs packed as ``links`` in order, and the distinct ``pairs`` with their ``times``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(arrow_pass(rows, _blocks(vocabulary_a, vocabulary_b, digest), BLOCK), "aligned")


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """How often each pair is linked in the corpus: ``pair, a_id, b_id, count, best`` (nothing is linked to the B id more often).

    Blocks have counted their pairs before, so a frequent pair has one row per block. A B id has at most as many rows as A has ids.
    """
    one = F.explode(F.arrays_zip("pairs", "times")).alias("one")
    counts = (blocks.select(one).groupBy(F.col("one.pairs").alias("pair")).agg(F.sum("one.times").alias("count"))
              .withColumn("b_id", F.col("pair") % size_b))
    most = F.max("count").over(Window.partitionBy("b_id"))
    return counts.select("pair", F.expr(f"pair div {size_b}L").alias("a_id"), "b_id", "count",
                         (F.col("count") == most).alias("best"))


_SCORED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups", pa.string())])


def _scored(kind: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, n_a, n_b, n_links, groups, links, found = (batch.column(c)[i] for c in range(7))
                links, n_links = np.frombuffer(links.as_py(), kind).astype(np.int64), n_links.values.to_numpy()
                best, total = np.zeros(len(n_links), np.int64), np.zeros(len(n_links), np.int64)
                if len(links):
                    table = found.values.flatten()
                    pair, count, top = (c.to_numpy(zero_copy_only=False) for c in table)
                    order = np.argsort(pair)
                    at = order[np.searchsorted(pair, links, sorter=order)]
                    edges = np.concatenate(([0], np.cumsum(n_links)))
                    for out, values in ((best, top.astype(np.int64)), (total, count)):
                        sums = np.concatenate(([0], np.cumsum(values[at])))[edges]
                        out[:] = np.diff(sums)
                yield batch_of(_SCORED, [doc_id.values, n_a.values, n_b.values, n_links, n_links, best, total, groups.values])
    return work


def scored(blocks: DataFrame, counts: DataFrame, kind: str = "<u4") -> DataFrame:
    """One row per text: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``.

    ``n_best`` are its links whose pair is the B id's most frequent one, ties included; ``count_sum`` adds up the counts of all its links.
    """
    asked = blocks.select("task", "block", F.explode("pairs").alias("pair"))
    told = (asked.join(counts.select("pair", "count", "best"), "pair").groupBy("task", "block")
            .agg(F.collect_list(F.struct("pair", "count", "best")).alias("found")))
    rows = blocks.drop("pairs", "times").join(told, ["task", "block"], "left")
    rows = rows.select("doc_id", "n_a", "n_b", "n_links", "groups", "links", "found")
    return rows.mapInArrow(_scored(kind), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                          "count_sum long, groups string")


def align(docs: DataFrame, vocabulary_a: str, vocabulary_b: str, digest: bool = False) -> DataFrame:
    """``scored`` for every text of ``docs``: A is a file of the ``tokenizers`` library, B one of ``sentencepiece``.

    * A reads a space and the text, B the text (it puts the space there itself); strings of special tokens are plain text.
    * Null and empty texts, and those whose tokens' bytes are not the space and the text, have no tokens: zeros, empty groups.
    * Repeated rows and ids are aligned and counted each; a null id stays. An empty table gives no rows. Other columns are ignored.
    """
    both = Aligner(vocabulary_a, vocabulary_b)
    blocks = aligned(docs, vocabulary_a, vocabulary_b, digest)
    counts = stored(pair_counts(blocks, len(both.bytes_b)), "pair-counts")
    return scored(blocks, counts, both.kind)
