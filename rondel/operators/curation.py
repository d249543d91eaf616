"""Text records ready for language-model use: rendering, quality rules, de-duplication, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rondel.operators.quality import keep_first
from rondel.session import spread


def sentence(parts: Sequence[str | Column]) -> Column:
    """Fixed words and column values, joined by blanks; null values are skipped.

    A plain string is a fixed word, a column is a value.
    """
    return F.concat_ws(" ", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def render_narrative(df: DataFrame, parts: Sequence[str | Column], *, keep: Sequence[str | Column] = (),
                     name: str = "text") -> DataFrame:
    """One ``sentence`` per row."""
    return df.select(*keep, sentence(parts).alias(name))


def with_provenance(df: DataFrame, *, source: str, version: str, text: str = "text") -> DataFrame:
    """Origin, version, curation time and 64-bit content hash of the text."""
    return df.select(
        "*", F.lit(source).alias("source"), F.lit(version).alias("version"),
        F.current_timestamp().alias("curated_at"), F.xxhash64(text).alias("content_hash"),
    )


def content_key(text: str | Column = "text") -> Column:
    """Identity of a text for de-duplication.

    256 bits: over a hundred billion texts a 64-bit hash is expected to merge hundreds of
    different ones.
    """
    return F.sha2(F.col(text) if isinstance(text, str) else text, 256)


def curate_text(df: DataFrame, *, text: str = "text", min_length: int = 100,
                order_by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Texts of at least ``min_length`` characters, each different text once.

    Of equal texts the first under ``order_by`` stays. Short texts go before anything is hashed. Winners are picked by hash and
    order alone; texts are never sorted, and a text that fills a third of the table is combined in the map task. Texts are read
    twice, so rendered ones should be stored first.
    """
    keyed = df.filter(F.length(text) >= min_length).withColumn("_key", F.unhex(content_key(text)))
    return keep_first(keyed, ["_key"], order_by).drop("_key")


def curate_rendered(df: DataFrame, text: Column, *, min_length: int = 100,
                    order_by: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The rows whose rendered ``text`` ``curate_text`` would keep, not yet rendered.

    ``text`` is an expression over ``df``. Only its hash travels, with the short columns it is made of, and only once: the first row
    of a hash is picked in an aggregate that is combined per map task. What ties under ``order_by`` is ordered by the other columns.
    """
    rest = [c for c in df.columns if c not in order_by]
    keyed = df.filter(F.length(text) >= min_length).select(F.unhex(content_key(text)).alias("_key"), *order_by, *rest)
    return keep_first(keyed, ["_key"]).drop("_key")


def curation_quality(df: DataFrame, *, text: str = "text", min_length: int = 100) -> DataFrame:
    """Rows before, rejected by each rule, and after, with the pass ratio. One pass over the text.

    Only text hashes are shuffled, counted per map task first.
    """
    verdict = (
        F.when(F.col(text).isNull(), "null_text")
        .when(F.length(text) < min_length, "too_short")
        .otherwise("eligible")
    )
    keyed = spread(df).select(verdict.alias("verdict"), F.unhex(content_key(text)).alias("key"))
    per_text = keyed.groupBy("verdict", F.when(F.col("verdict") == "eligible", F.col("key")).alias("key")).agg(
        F.count("*").alias("copies"))
    of = lambda v, c: F.coalesce(F.sum(F.when(F.col("verdict") == v, c)), F.lit(0))
    counted = per_text.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_before"),
        of("null_text", F.col("copies")).alias("null_text"),
        of("too_short", F.col("copies")).alias("too_short"),
        of("eligible", F.col("copies") - 1).alias("duplicate"),
        F.count_if(F.col("verdict") == "eligible").alias("total_after"),
    )
    return counted.withColumn(
        "pass_ratio", F.try_divide(F.col("total_after").cast("double"), F.col("total_before").cast("double")))


def dataset_card(df: DataFrame, *, name: str, source: str, version: str, intended_use: str,
                 filters: Sequence[str], text: str = "text") -> DataFrame:
    """One-row profile: size, text lengths, and the columns with their types as JSON text."""
    fields = F.to_json(F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())]))
    return df.agg(
        F.count("*").alias("size_rows"),
        F.sum(F.length(text)).alias("size_chars"),
        F.min(F.length(text)).alias("min_chars"),
        F.max(F.length(text)).alias("max_chars"),
    ).select(
        F.lit(name).alias("name"), F.lit(source).alias("source"), F.lit(version).alias("version"), "*",
        fields.alias("schema"),
        F.array_join(F.array(*[F.lit(f) for f in filters]), "; ").alias("quality_filters"),
        F.lit(intended_use).alias("intended_use"),
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """Column names and types of a data set, as rows beside its card."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)],
        "position int, column string, type string, nullable boolean")
