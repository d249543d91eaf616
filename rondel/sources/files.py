"""Batch readers for CSV and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, types as T


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType, *, columns=None,
                   null_value: str = "", **options) -> DataFrame:
    """Header CSV under a declared schema.

    CSV binds columns by position, so ``schema`` must list every column of the file in file
    order; narrow the result by name with ``columns`` instead of passing a shorter schema.
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", null_value)
        .options(**options)
        .csv(path)
    )
    return df.select(*columns) if columns else df


def read_csv_strings(spark: SparkSession, path: str, **options) -> DataFrame:
    """Header CSV with every column kept as text, as a raw layer needs it."""
    return spark.read.option("header", True).option("inferSchema", False).options(**options).csv(path)


def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").option("header", True).options(**options).csv(path)


def read_parquet(spark: SparkSession, path: str, columns=None, where: Column | None = None) -> DataFrame:
    """Parquet scan; the filter and the column list both reach the reader."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def land_raw(spark: SparkSession, source_csv: str, target: str) -> DataFrame:
    """Copy a raw CSV into the bronze directory without typing it, and read the copy back."""
    write_csv(read_csv_strings(spark, source_csv), target)
    return read_csv_strings(spark, target)
