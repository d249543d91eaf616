"""Substring de-duplication with a compressed full-text index per shard.

A window is a fixed number of consecutive words of one document; a word is removed if it lies in a window whose words
also start anywhere else. Every window has an anchor, the shingle in it with the least hash, so equal windows have equal
anchors and windows whose anchor occurs once are unique. The windows around the other anchors are cut out as
segments, equal segments are merged and counted, and a segment goes to the shard of its anchor. There an index of all segments is
built (Burrows-Wheeler transform in a wavelet matrix) and the segments are streamed against it: backward search gives
the matching statistics behind every window end, and a window is repeated if its match is as long as the window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rondel.llm.fm_index import FmIndex
from rondel.llm.shared import (
    BitFilter, WordHasher, arrow_pass, batch_of, mixed, quoted, rolling, small_batches, stored, text_chunks)

WINDOW_WORDS = 35
ANCHOR_WORDS = 12
# Segments of one shard; an anchor with more different segments than a quarter of it is dealt by whole windows.
SHARD_SEGMENTS = 8000


class Anchored:
    """Segments of all texts of a chunk: runs of windows of one text that share an anchor."""

    def __init__(self, hasher: WordHasher, texts: list[bytes], size: int, k: int):
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, _, self.words = hasher.words(data)
        cuts = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(cuts, starts, side="right")
        self.first_word = np.searchsorted(doc, np.arange(len(texts)))
        n = len(self.words) - size + 1
        empty = np.empty(0, np.int64)
        self.text, self.start, self.count, self.anchor, self.content = empty, empty, empty, empty, empty
        if n <= 0:
            return
        h = mixed(rolling(self.words, k))
        span = size - k + 1
        least = h[:n].copy()
        place = np.arange(n)
        for i in range(1, span):
            lower = h[i:n + i] < least
            least[lower] = h[i:n + i][lower]
            place[lower] = np.flatnonzero(lower) + i
        whole = doc[:n] == doc[size - 1:]  # windows inside one text
        at = np.flatnonzero(whole)
        if not len(at):
            return
        new = np.ones(len(at), bool)
        new[1:] = (place[at][1:] != place[at][:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        self.start = at[first]
        self.count = np.diff(np.append(first, len(at)))
        self.text = doc[self.start]
        self.anchor = h[place[self.start]].view(np.int64)
        # Content: the words of the segment, hashed from running sums of their polynomial.
        with np.errstate(over="ignore"):
            powers = hasher.powers if len(hasher.powers) > len(self.words) else None
            sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed(self.words ^ np.uint64(0xA5A5A5A5)) * powers[:len(self.words)])))
            end = self.start + self.count + size - 1
            value = (sums[end] - sums[self.start]) * hasher.inverse[self.start]
            self.content = mixed(value + np.uint64(0x2545F4914F6CDD1D) * self.count.astype(np.uint64)).view(np.int64)

    def segment(self, i: int, size: int) -> np.ndarray:
        return self.words[self.start[i]:self.start[i] + self.count[i] + size - 1]


def _anchors(size: int, k: int):
    schema = pa.schema([("anchor", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for _, texts in text_chunks(batch.column(0).to_pylist()):
                yield batch_of(schema, [Anchored(hasher, texts, size, k).anchor])
    return work


def _occurrences(size: int, k: int, wanted: BitFilter):
    """Segments whose anchor may occur again: which text, the first window's place, and what they hold."""
    schema = pa.schema([("key", pa.binary()), ("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()),
                        ("content", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for _, texts in text_chunks(batch.column(0).to_pylist()):
                found = Anchored(hasher, texts, size, k)
                keep = np.flatnonzero(wanted.passes(found.anchor))
                keys = {t: _key(texts[t]) for t in np.unique(found.text[keep]).tolist()}
                yield batch_of(schema, [
                    [keys[t] for t in found.text[keep].tolist()],
                    (found.start[keep] - found.first_word[found.text[keep]]).astype(np.int32),
                    found.count[keep].astype(np.int32), found.anchor[keep], found.content[keep]])
    return work


def _key(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()[:16]


def _contents(size: int, k: int, wanted: BitFilter):
    """The words, as hashes, of the segments asked for; once per task."""
    schema = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("words", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, given = WordHasher(), set()
        for batch in batches:
            for _, texts in text_chunks(batch.column(0).to_pylist()):
                found = Anchored(hasher, texts, size, k)
                ask = np.flatnonzero(wanted.passes(found.content))
                out: tuple[list, list, list] = ([], [], [])
                for i, a, c in zip(ask.tolist(), found.anchor[ask].tolist(), found.content[ask].tolist()):
                    if (a, c) in given:
                        continue
                    if len(given) < 1_000_000:
                        given.add((a, c))
                    out[0].append(a)
                    out[1].append(c)
                    out[2].append(found.segment(i, size).tobytes())
                yield batch_of(schema, list(out))
    return work


def search_shard(words: list[np.ndarray], alone: np.ndarray, size: int) -> list[np.ndarray]:
    """For each segment which of its windows occur again in the shard; ``alone`` marks segments that occur once.

    Windows of other segments are repeated already, as the whole segment is.
    """
    lengths = np.array([len(w) for w in words])
    joined = np.concatenate(words)
    _, codes = np.unique(joined, return_inverse=True)
    # Each segment ends in a mark of its own, so that no match crosses it.
    text = np.empty(len(joined) + len(words), np.int64)
    ends = np.cumsum(lengths + 1) - 1
    inner = np.ones(len(text), bool)
    inner[ends] = False
    text[inner] = codes + len(words)
    text[ends] = np.arange(len(words))[::-1]  # the last symbol of all is the least and unique
    index = FmIndex(text, size)
    begins = ends - lengths
    counts = lengths - size + 1
    asked = np.flatnonzero(alone)
    stops = np.concatenate([np.arange(begins[i] + size, ends[i] + 1) for i in asked]) if len(asked) else np.empty(0, int)
    match = np.empty(len(stops), np.int64)
    for i in range(0, len(stops), 1 << 18):
        match[i:i + (1 << 18)] = index.matching(text, stops[i:i + (1 << 18)], size)
    repeated = match >= size
    out = [np.ones(c, bool) for c in counts]
    at = 0
    for i in asked.tolist():
        out[i] = repeated[at:at + counts[i]]
        at += counts[i]
    return out


def _search(size: int):
    def work(table: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, "<u8") for w in table.column("words").to_pylist()]
        alone = table.column("copies").to_numpy() < 2
        found = search_shard(words, alone, size)
        masks = [int(sum(1 << int(j) for j in np.flatnonzero(f))) for f in found]
        return pa.table({"one": table.column("one"), "two": table.column("two"),
                         "mask": pa.array(masks, pa.int64())})
    return work


def repeated_windows(docs: DataFrame, size: int = WINDOW_WORDS, k: int = ANCHOR_WORDS) -> DataFrame:
    """``key`` (of a text) and ``windows``: the word numbers where repeated windows of that text start."""
    if not 0 < k <= size or size - k + 1 > 62:
        raise ValueError("anchors must be shorter than windows, by at most 61 words")
    texts = docs.select(F.col("text").cast("string").alias("text"))
    anchors = arrow_pass(texts, _anchors(size, k), "anchor long")
    again = stored(anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
    found = arrow_pass(texts, _occurrences(size, k, BitFilter(again)),
                       "key binary, start int, n int, anchor long, content long")
    found = stored(found, "segment-occurrences")
    segments = stored(found.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.first("n").alias("n")),
                      "segments")
    anchors = segments.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("copies").alias("total"))
    anchors = stored(anchors.filter("total > 1"), "anchor-kinds")
    segments = stored(segments.join(anchors, "anchor").select("anchor", "content", "copies", "n", "kinds"), "segments")
    several = segments.filter("kinds > 1")

    contents = arrow_pass(texts, _contents(size, k, BitFilter(several.select("content"))),
                          "anchor long, content long, words binary")
    contents = contents.groupBy("anchor", "content").agg(F.first("words").alias("words"))
    held = stored(several.join(contents, ["anchor", "content"]), "segment-words")
    hot = F.col("kinds") > SHARD_SEGMENTS // 4

    # Segments of a crowded anchor are taken apart, so that their windows can be dealt to many shards by what they hold.
    step = 8
    pieces = held.filter(hot).select(
        "anchor", "content", "copies", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"),
        F.expr(f"substring(words, {step} * j + 1, {step} * {size})").alias("words"))
    pieces = pieces.select("anchor", "content", "j", "copies", "words", F.xxhash64("words").alias("one"),
                           F.xxhash64("words", F.lit(1)).alias("two"))
    units = (held.filter(~hot).select(F.col("anchor").alias("one"), F.col("content").alias("two"), "copies", "words")
             .unionByName(pieces.groupBy("one", "two").agg(F.sum("copies").alias("copies"),
                                                           F.first("words").alias("words"))))
    units = stored(units, "shard-units")
    shards = max(1, units.count() // SHARD_SEGMENTS + 1)
    masks = (units.withColumn("shard", F.pmod(F.xxhash64("one"), F.lit(shards)))
             .groupBy("shard").applyInArrow(_search(size), "one long, two long, mask long"))
    masks = stored(masks.filter("mask <> 0"), "shard-matches")

    cold = masks.join(held.filter(~hot).select(F.col("anchor").alias("one"), F.col("content").alias("two")),
                      ["one", "two"], "left_semi").toDF("anchor", "content", "mask")
    warm = (pieces.select("anchor", "content", "j", "one", "two").join(masks, ["one", "two"])
            .groupBy("anchor", "content").agg(F.bit_or(F.expr("shiftleft(1L, j)")).alias("mask")))
    whole = segments.filter("kinds = 1 AND copies > 1").select(
        "anchor", "content", F.expr("shiftleft(1L, n) - 1").alias("mask"))
    repeated = cold.unionByName(warm).unionByName(whole)
    starts = F.expr("transform(filter(sequence(0, n - 1), j -> (mask & shiftleft(1L, j)) <> 0), j -> start + j)")
    return (found.join(repeated, ["anchor", "content"]).select("key", F.explode(starts).alias("window"))
            .groupBy("key").agg(F.collect_set("window").alias("windows")))


def without_repeats(docs: DataFrame, size: int = WINDOW_WORDS, k: int = ANCHOR_WORDS) -> DataFrame:
    """``doc`` (the input row as a struct), ``text`` (the words that stay, joined by one space), ``n_words`` and ``n_removed``.

    Words are what stands between ASCII white space, unchanged. Windows are judged on the input, not on what is left.

    * Null has no words; its text is null. Texts shorter than a window lose nothing (but white space is made even).
    * Copies of a text are repeats of each other: all their windows go, in each of them.
    * Rows may repeat or lack ids; every row is judged by its own text. An empty table gives no rows.
    * Only ``text`` is read; other columns may have any name.
    """
    windows = repeated_windows(docs, size, k)
    text = F.col("doc.text").cast("string")
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"))
    key = F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)
    joined = rows.withColumn("_key", key).join(windows.withColumnRenamed("key", "_key"), "_key", "left")

    small_batches(docs.sparkSession)

    @F.pandas_udf("text string, n_words long, n_removed long")
    def cut(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for value, starts in zip(texts, found):
            words = value.encode("utf-8", "surrogatepass").split() if value else []
            gone = 0
            kept = words
            if starts is not None and len(starts):
                cover = np.zeros(len(words) + size + 1, np.int64)
                np.add.at(cover, starts, 1)
                np.add.at(cover, np.asarray(starts) + size, -1)
                stay = np.cumsum(cover)[:len(words)] == 0
                gone = int(len(words) - stay.sum())
                kept = [words[i] for i in np.flatnonzero(stay).tolist()]
            out.append((None if value is None else b" ".join(kept).decode("utf-8", "surrogatepass"), len(words), gone))
        return pd.DataFrame(out, columns=["text", "n_words", "n_removed"])

    done = cut(text, F.col("windows")).alias("done")
    return joined.select("doc", done).select("doc", "done.text", "done.n_words", "done.n_removed")
