"""Partitioned table writes, compaction and file inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """Overwrite ``path`` as a table partitioned by ``by``, with files of even size.

    The rebalance hint groups rows by partition value so that each value gets few files, and
    lets adaptive execution cut a value that holds too many rows into several tasks: neither
    thousands of small files nor one task writing a third of the table.
    """
    even = df.hint("rebalance", *by)
    even.sortWithinPartitions(*by, *sort_by).write.mode("overwrite").partitionBy(*by).parquet(path)


def compact(spark: SparkSession, source: str, target: str, by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """Rewrite a partitioned table with few, sorted files per partition value."""
    write_partitioned(spark.read.parquet(source), target, by, sort_by)


# Bytes a data file should have, about.
TARGET_BYTES = 128 << 20


def partition_files(spark: SparkSession, path: str, by: Sequence[str]) -> DataFrame:
    """One row per data file of a partitioned table: the values of ``by`` as text, ``path`` and ``bytes``."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Names of directories escape some signs of a value by their codes; a plus sign stands for itself. Contents are not read.
    value = lambda c: F.url_decode(F.replace(F.regexp_extract("path", f"/{c}=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))).alias(c)
    return found.select(*[value(c) for c in by], F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"))


def crowded_files(spark: SparkSession, path: str, by: Sequence[str], target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Files of the partitions that have more of them than their bytes ask for, each with the ``bin`` it should go to.

    Files are laid end to end in the order of their names; a bin is ``target_bytes`` of that.
    """
    files = partition_files(spark, path, by)
    whole = Window.partitionBy(*by)
    end = F.sum("bytes").over(whole.orderBy("path").rowsBetween(Window.unboundedPreceding, 0))
    sized = files.select("*", F.floor((end - 1) / F.lit(target_bytes)).alias("bin"), F.count("*").over(whole).alias("_files"),
                         F.ceil(F.sum("bytes").over(whole) / F.lit(target_bytes)).alias("_wanted"))
    return sized.filter(F.col("_files") > F.col("_wanted")).drop("_files", "_wanted")


def compact_in_place(spark: SparkSession, path: str, by: Sequence[str], sort_by: Sequence[str] = (), *, staging: str,
                     target_bytes: int = TARGET_BYTES) -> int:
    """Merge the small files of a partitioned table; returns the number of files that were read.

    Only partitions with too many files are rewritten, each bin by one task. Their rows are stored at ``staging`` before they replace
    the old files, so a failure leaves the table as it was or the rows at hand. Nothing else may write to the table meanwhile.
    """
    crowded_files(spark, path, by, target_bytes).write.mode("overwrite").parquet(f"{staging}/files")
    files = spark.read.parquet(f"{staging}/files")
    n, groups = files.count(), files.select(*by, "bin").distinct().count()
    if not n:
        return 0
    rows = spark.read.parquet(path)
    moved = rows.select("*", F.col("_metadata.file_path").alias("_path")).join(
        files.select(F.col("path").alias("_path"), F.col("bin").alias("_bin")), "_path").drop("_path")
    moved.write.mode("overwrite").parquet(f"{staging}/rows")
    # twice as many ranges as bins, so that sampled bounds part neighbouring bins
    dealt = spark.read.schema(moved.schema).parquet(f"{staging}/rows").repartitionByRange(2 * groups, *by, "_bin")
    (dealt.sortWithinPartitions(*by, "_bin", *sort_by).select(*rows.columns)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    return n


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file below ``path``: format, location, bytes. File contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", F.col("length").alias("bytes"))
    )
    extension = F.regexp_extract("path", r"\.([a-z0-9]+)$", 1)
    return found.select(extension.alias("format"), "path", "bytes")


def layout_stats(spark: SparkSession, phases: dict[str, str]) -> DataFrame:
    """File count and bytes of each named location, by format."""
    parts = [file_inventory(spark, path).select(F.lit(phase).alias("phase"), "format", "bytes")
             for phase, path in phases.items()]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("phase", "format").agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.max("bytes").alias("largest_file"),
    )


def footprint_ratio(stats: DataFrame, subject: str, reference: str) -> DataFrame:
    """Bytes of format ``subject`` as a share of format ``reference``, over all phases."""
    size = lambda fmt: F.sum(F.when(F.col("format") == fmt, F.col("bytes")))
    return stats.agg(
        size(subject).alias("subject_bytes"), size(reference).alias("reference_bytes"),
    ).withColumn("ratio", F.try_divide(F.col("subject_bytes").cast("double"), F.col("reference_bytes").cast("double")))
