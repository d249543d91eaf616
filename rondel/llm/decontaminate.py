"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A benchmark item is cut into windows of consecutive words; a document word inside any occurrence of a
window is hit. The tokens of the join are the shingles of a window (five words, or the whole window if it
is shorter), ordered by how often documents hold them. A window is contained only if its rarest shingle
is, so that one shingle is its necessary prefix: documents and windows meet on it alone, places where the
window would not fit are cut by position and length, and what is left is compared word for word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rondel.llm.shared import arrow_pass, batch_of, dense, plain_words, rolling, stored, union_length

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
# Bits of the filter that lets a document's shingles pass; its size does not depend on the benchmark.
FILTER_BITS = 1 << 23
_KNOWN_WORDS = 500_000


class WordCodes(dict):
    """Words to 64-bit codes; forgets all when it has grown to a limit."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return code


def _hashes(codes: np.ndarray, k: int) -> np.ndarray:
    return rolling(codes, k) ^ np.uint64(k)


def _windows(size: int):
    """Windows of an item's words: ``WORDS`` consecutive ones, or all of a shorter item."""
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.list_(pa.string())),
                        ("shingles", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCodes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for item, text in zip(ids, texts):
                words = plain_words(text)
                for i in range(max(1, len(words) - size + 1) if words else 0):
                    window = words[i:i + size]
                    codes = np.fromiter(map(known.__getitem__, window), np.uint64, len(window))
                    out[0].append(item)
                    out[1].append(window)
                    out[2].append(_hashes(codes, min(SHINGLE_WORDS, len(window))).view(np.int64).tolist())
            yield batch_of(schema, list(out))
    return work


def _filter_bits(shingles: DataFrame) -> np.ndarray:
    """The fixed-size filter of all window shingles; ``FILTER_BITS`` bits reach the driver."""
    bit = F.col("shingle").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (shingles.select(F.shiftright(bit, 6).alias("at"),
                             F.expr("shiftleft(1L, cast(shingle & 63 as int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("value")))
    return dense(words, FILTER_BITS // 64, "<i8").view(np.uint64)


def _segments(bits: np.ndarray, lengths: list[int], id_type: pa.DataType):
    """Per document its words, and the stretches of words that may hold a window.

    ``lengths``: the window lengths that occur, at most ``WINDOW_WORDS`` of them. A window can only lie
    where all its shingles pass the filter; stretches that overlap are joined.
    """
    schema = pa.schema([("row", pa.int64()), ("doc_id", id_type), ("n_words", pa.int64()),
                        ("segments", pa.list_(pa.string()))])
    least: dict[int, int] = {}  # shingle length to the fewest consecutive shingles that a window needs
    for length in lengths:
        k = min(SHINGLE_WORDS, length)
        least[k] = min(least.get(k, length), length - k + 1)

    def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
        found = []
        for k, run in least.items():
            h = _hashes(codes, k)
            at = h & np.uint64(FILTER_BITS - 1)
            hit = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1)
            if not hit.any():
                continue
            edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            keep = end - begin >= run
            found += zip(begin[keep].tolist(), (end[keep] + k - 1).tolist())
        joined: list[tuple[int, int]] = []
        for begin, end in sorted(found):
            if joined and begin < joined[-1][1]:
                joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
            else:
                joined.append((begin, end))
        return joined

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = WordCodes(), TaskContext.get().partitionId() << 36
        for batch in batches:
            rows, counts, parts = [], [], []
            for text in batch.column(1).to_pylist():
                words = plain_words(text)
                codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                rows.append(row)
                counts.append(len(words))
                parts.append([" ".join(words[a:b]) for a, b in stretches(codes)])
                row += 1
            yield batch_of(schema, [rows, batch.column(0), counts, parts])
    return work


def _segment_shingles(lengths: list[int]):
    schema = pa.schema([("segment", pa.string()), ("at", pa.int64()), ("shingle", pa.int64())])
    sizes = sorted({min(SHINGLE_WORDS, n) for n in lengths})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordCodes()
        for batch in batches:
            keys, places, shingles = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.split(" ")
                codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                for k in sizes:
                    h = _hashes(codes, k).view(np.int64)
                    keys += [key] * len(h)
                    places.append(np.arange(len(h)))
                    shingles.append(h)
            if keys:
                yield batch_of(schema, [keys, np.concatenate(places), np.concatenate(shingles)])
    return work


def contaminated(docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``) what ``benchmark`` (``item_id``, ``text``) explains of it.

    Columns: ``doc_id``, ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``items`` (sorted
    distinct ids of items with occurring windows), ``contaminated``. Other columns are ignored.

    * Null and wordless texts have no words: no hits in a document, no window of an item.
    * A repeated document is judged row by row; repeated items count once. A null ``doc_id`` is kept; an
      item without id marks words but is not listed.
    * Empty tables give no rows, or documents without hits.
    * Equal stretches of different documents are judged once, so a passage copied into a third of the
      corpus is one row of the join; the only broadcast is a filter of fixed size.
    """
    windows = stored(arrow_pass(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")),
                                _windows(window_words),
                                "item_id long, words array<string>, shingles array<long>"), "windows")
    texts = F.concat_ws(" ", "words")
    distinct = windows.groupBy(texts.alias("window")).agg(F.any_value("shingles").alias("shingles"))
    shingles = distinct.select(
        "window", F.size(F.split("window", " ")).alias("length"),
        F.posexplode("shingles").alias("offset", "shingle"))
    lengths = [r[0] for r in windows.select(F.size("words").alias("n")).distinct().collect()]
    bits = _filter_bits(shingles)

    id_type = docs.schema["doc_id"].dataType
    judged = stored(arrow_pass(docs.select("doc_id", F.col("text").cast("string")),
                               _segments(bits, lengths, to_arrow_type(id_type)),
                               f"row long, doc_id {id_type.simpleString()}, n_words long, segments array<string>"),
                    "segments")
    placed = judged.select("row", F.explode("segments").alias("text"))
    segments = stored(placed.groupBy("text").agg(F.count("*").alias("copies"))
                      .withColumn("segment", F.sha2("text", 256)), "distinct-segments")
    tokens = arrow_pass(segments.select("segment", "text"), _segment_shingles(lengths),
                        "segment string, at long, shingle long")

    # Rarity over all documents, and of each window the rarest shingle; a window with one that no document holds is out.
    rarity = (tokens.join(segments.select("segment", "copies"), "segment")
              .groupBy("shingle").agg(F.sum("copies").alias("seen")))
    ranked = shingles.join(rarity, "shingle", "left")
    order = Window.partitionBy("window").orderBy(F.col("seen").asc_nulls_first(), "shingle", "offset")
    prefix = (ranked.withColumn("place", F.row_number().over(order))
              .filter("place = 1 AND seen IS NOT NULL").select("window", "length", "offset", "shingle"))

    meets = tokens.join(prefix, "shingle").select(
        "segment", "window", "length", (F.col("at") - F.col("offset")).alias("start")).filter("start >= 0")
    words = segments.select("segment", F.split("text", " ").alias("words"))
    found = (meets.join(words, "segment")
             .filter((F.col("start") + F.col("length") <= F.size("words"))
                     & (F.concat_ws(" ", F.slice("words", F.col("start").cast("int") + 1, F.col("length")))
                        == F.col("window")))
             .select("segment", "window", "start", "length"))
    found = stored(found, "occurrences")
    hits = found.groupBy("segment").agg(
        union_length(F.collect_set(F.struct("start", "length"))).alias("n_hit"))
    owners = windows.select(texts.alias("window"), "item_id").distinct()
    items = (found.select("segment", "window").distinct().join(owners, "window")
             .groupBy("segment").agg(F.collect_set("item_id").alias("items")))
    per_segment = hits.join(items, "segment", "left")
    per_row = (placed.select("row", F.sha2("text", 256).alias("segment")).join(per_segment, "segment")
               .groupBy("row").agg(F.sum("n_hit").alias("n_hit"),
                                   F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")))
    none = F.array().cast("array<bigint>")
    return judged.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.array_sort(F.coalesce("items", none)).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window_words: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns.

    Each row is judged by its own text, whatever its id; null texts are clean and stay.
    """
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    hit = contaminated(docs.select(digest.alias("doc_id"), "text"), benchmark, window_words)
    hit = hit.filter("contaminated").select(F.col("doc_id").alias("_digest")).distinct()
    return docs.join(hit, digest == F.col("_digest"), "left_anti")
