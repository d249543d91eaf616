"""Corpus assembly, tokenising, and an inverted index stored in bounded posting blocks.

A posting list is never held as one array per token: a token found in a third of all documents
would need a third of all document ids in a single row. The index has one row per
``(token, block)``, and a block covers a limited set of documents, so every row stays small
whatever the token. Hit counts and postings over a whole token are sums and unions of its blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rondel.functions.tokens import is_kept, token_array
from rondel.operators.quality import keep_first
from rondel.session import spread
from rondel.sources.files import write_csv
from rondel.sources.layout import write_partitioned

# Most documents one posting block may cover.
BLOCK_WIDTH = 1 << 14


def corpus_build(df: DataFrame, *, id_parts: Sequence[str | Column], text_parts: Sequence[str | Column],
                 required: Sequence[str], keep: Sequence[str] = (),
                 order_by: Sequence[str] = ()) -> DataFrame:
    """``doc_id`` and ``text`` per source row, one row per ``doc_id``.

    The id is null if any part is null, so required columns are checked first; the text skips
    null parts.
    """
    pieces = [part for p in id_parts for part in (F.lit("_"), _text(p))][1:]
    docs = df.dropna(subset=list(required)).select(
        F.concat(*pieces).alias("doc_id"),
        F.concat_ws(" ", *[_text(p) for p in text_parts]).alias("text"),
        *keep,
    )
    return keep_first(docs, ["doc_id"], order_by)


def _text(part: str | Column) -> Column:
    return (F.col(part) if isinstance(part, str) else part).cast("string")


def raw_tokens(docs: DataFrame, *, rule: str, doc_id: str = "doc_id", text: str = "text",
               extra: Sequence[Column] = ()) -> DataFrame:
    """One row per non-empty token occurrence."""
    return (
        spread(docs)
        .select(F.col(doc_id).alias("doc_id"), *extra, F.explode(token_array(F.col(text), rule)).alias("token"))
        .filter(F.length("token") > 0)
    )


def tokenize(docs: DataFrame, *, rule: str, stop_words=None, min_length: int = 2, **columns) -> DataFrame:
    """Token occurrences that pass the length limit and the stop list."""
    return raw_tokens(docs, rule=rule, **columns).filter(is_kept(F.col("token"), rule, stop_words, min_length))


def token_reduction(docs: DataFrame, *, rule: str, stop_words=None, min_length: int = 2, **columns) -> DataFrame:
    """Token counts before and after filtering and the reduction in percent, in one pass."""
    kept = is_kept(F.col("token"), rule, stop_words, min_length)
    counted = raw_tokens(docs, rule=rule, **columns).agg(
        F.count("*").alias("tokens_raw"), F.count_if(kept).alias("tokens_clean"),
    )
    lost = (F.col("tokens_raw") - F.col("tokens_clean")).cast("double")
    return counted.withColumn("reduction_pct", F.try_divide(lost * 100, F.col("tokens_raw").cast("double")))


def id_block(doc_id: str | Column, width: int = BLOCK_WIDTH) -> Column:
    """Block of a numeric document id: at most ``width`` ids share a block, however ids are spread."""
    value = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    value, width = value.cast("bigint"), F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, width), width)  # exact beyond 2^53


def blocks_for(documents: int, width: int = BLOCK_WIDTH) -> int:
    """Number of hash blocks that keeps about ``width`` documents in each."""
    return max(1, -(-documents // width))


def hash_block(doc_id: str | Column, blocks: int) -> Column:
    """Block of any document id, by hash; take ``blocks`` from ``blocks_for`` so that it grows with the corpus."""
    value = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.xxhash64(value), F.lit(blocks)).cast("bigint")


def inverted_index(tokens: DataFrame, *, block: Column, distinct: bool) -> DataFrame:
    """``token, block, doc_ids, freq`` from token occurrences.

    ``distinct`` keeps each document once per token; otherwise a document appears once per
    occurrence. ``freq`` counts occurrences either way. Postings are sorted.
    """
    collected = F.collect_set("doc_id") if distinct else F.collect_list("doc_id")
    return (
        tokens.withColumn("block", block)
        .groupBy("token", "block")
        .agg(F.sort_array(collected).alias("doc_ids"), F.count("*").alias("freq"))
    )


# Directories of a stored index.
INDEX_BUCKETS = 64


def token_bucket(token: Column, buckets: int = INDEX_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def write_index(index: DataFrame, path: str, buckets: int = INDEX_BUCKETS) -> None:
    """Store the index below one directory per token bucket, sorted by token inside each file.

    A lookup opens the directories of its words only, and skips row groups inside them. The bucket of a hot token is cut into
    several files.
    """
    bucketed = index.withColumn("bucket", token_bucket(F.col("token"), buckets))
    write_partitioned(bucketed, path, ["bucket"], ["token", "block"])


def _of_words(index: DataFrame, words: Sequence[str], buckets: int) -> DataFrame:
    """Rows of ``words``; of a stored index only their directories are listed and read."""
    wanted = F.col("token").isin(*words)
    if "bucket" in index.columns:
        wanted = F.col("bucket").isin(*[token_bucket(F.lit(w), buckets) for w in words]) & wanted
    return index.filter(wanted)


def term_stats(index: DataFrame) -> DataFrame:
    """Posting list length, occurrences and block count per token, over all its blocks."""
    return index.groupBy("token").agg(
        F.sum(F.size("doc_ids")).alias("postings"), F.sum("freq").alias("freq"), F.count("*").alias("blocks"),
    )


def top_terms(index: DataFrame, n: int) -> DataFrame:
    """The ``n`` most frequent tokens; equal frequencies are ordered by token."""
    return term_stats(index).orderBy(F.desc("freq"), "token").limit(n)


def index_lookup(index: DataFrame, terms: DataFrame, term: str = "term") -> DataFrame:
    """Hit count and frequency per wanted term; a term not in the index has 0 hits.

    The index is cut down to the wanted terms and summed before the outer join, so only the
    few remaining rows take part in it.
    """
    wanted = terms.select(F.col(term).alias("term")).distinct()
    found = term_stats(index.join(wanted, index["token"] == wanted["term"], "left_semi"))
    return wanted.join(found, wanted["term"] == found["token"], "left").select(
        "term",
        F.coalesce("postings", F.lit(0)).alias("hits"),
        F.coalesce("freq", F.lit(0)).alias("freq"),
    )


def lookup_terms(spark: SparkSession, index: DataFrame, words: Sequence[str], buckets: int = INDEX_BUCKETS) -> DataFrame:
    """``index_lookup`` for words known to the caller: directories and row groups without them are not read."""
    return index_lookup(_of_words(index, words, buckets), spark.createDataFrame([(w,) for w in words], "term string"))


def postings(index: DataFrame, words: Sequence[str], buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Matching documents as rows, not as one array per term."""
    return _of_words(index, words, buckets).select("token", F.explode("doc_ids").alias("doc_id"))


def index_to_csv(index: DataFrame, path: str, separator: str = "|") -> None:
    """CSV has no arrays: the postings of a block become one separated string."""
    write_csv(index.withColumn("doc_ids", F.array_join(F.col("doc_ids").cast("array<string>"), separator)), path)


def index_from_csv(spark: SparkSession, path: str, doc_id_type: str = "string", separator: str = "|") -> DataFrame:
    """Read back what ``index_to_csv`` wrote."""
    rows = spark.read.option("header", True).csv(path, schema="token string, block bigint, doc_ids string, freq bigint")
    ids = F.split("doc_ids", f"\\Q{separator}\\E").cast(f"array<{doc_id_type}>")
    return rows.withColumn("doc_ids", ids)
