"""File stream sources and the landing writer that feeds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rondel.sources.layout import file_inventory


def _stream(spark: SparkSession, schema: T.StructType, files_per_trigger: int | None, newest_first: bool):
    reader = spark.readStream.schema(schema).option("latestFirst", newest_first)
    return reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)


def json_stream(spark: SparkSession, path: str, schema: T.StructType, *,
                files_per_trigger: int | None = None, newest_first: bool = False) -> DataFrame:
    """JSON-lines directory as a stream, oldest file first unless told otherwise."""
    return _stream(spark, schema, files_per_trigger, newest_first).json(path)


def csv_stream(spark: SparkSession, path: str, schema: T.StructType, *,
               files_per_trigger: int | None = None, newest_first: bool = False) -> DataFrame:
    """Header CSV directory as a stream."""
    return _stream(spark, schema, files_per_trigger, newest_first).option("header", True).csv(path)


# Text that one landing file should hold, about, and how much longer a row is as text than in a column file.
LANDING_BYTES = 32 << 20
TEXT_FACTOR = 4


def landing_width(spark: SparkSession, source: str, least: int = 1, most_bytes: int = LANDING_BYTES) -> int:
    """How many landing files the table at ``source`` should become, from the bytes of its files; contents are not read."""
    size = file_inventory(spark, source).agg(F.sum("bytes")).first()[0] or 0
    return max(least, -(-size * TEXT_FACTOR // most_bytes))


# Microseconds survive the text formats only under an explicit pattern.
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def land_files(df: DataFrame, path: str, files: int, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write ``df`` as about ``files`` landing files for a stream to replay.

    Rows are dealt round-robin, so a hot key cannot make one file larger than the others.
    """
    writer = df.repartition(files).write.mode(mode).option("timestampFormat", TIMESTAMP_TEXT)
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def land_in_order(df: DataFrame, path: str, time: str, slices: int, files: int, fmt: str = "json") -> None:
    """Land ``df`` in ``slices`` of equal time span, oldest first, of about ``files`` files together.

    A stream then reads no row that is older than a row of an earlier batch by more than one slice.
    """
    low, high = df.agg(F.min(time), F.max(time)).first()
    if low is None:
        return land_files(df, path, files, fmt)
    step = (high - low) / slices
    for i in range(slices):
        after = F.lit(True) if i == 0 else F.col(time) >= F.lit(low + i * step)
        before = F.lit(True) if i == slices - 1 else F.col(time) < F.lit(low + (i + 1) * step)
        land_files(df.filter(after & before), path, -(-files // slices), fmt, "overwrite" if i == 0 else "append")
