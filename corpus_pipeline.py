"""A corpus from raw documents to packed token sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rondel.llm import decontaminate, line_dedup, packing, quality, simhash
from rondel.llm.shared import stored, table
from rondel.llm.tokens import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.good_documents(docs, quality.document_labels(table(spark, sf_dir, "labels")))


def line_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier line."""
    return line_dedup.dedup_lines(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the token sequences."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("line dedup", line_once),
    ("SimHash near-dedup", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("packing", packed),
]

# A classifier's fit has no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
