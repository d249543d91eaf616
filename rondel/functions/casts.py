"""Text-to-type conversion that yields null, never an error, on bad input."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T


def parse(name: str, target: T.DataType, pattern: str | None = None) -> Column:
    """Column ``name`` as ``target``; null where the text does not parse."""
    source = F.col(name)
    if pattern and isinstance(target, T.DateType):
        return F.try_to_date(source, pattern)
    if pattern and isinstance(target, T.TimestampType):
        return F.try_to_timestamp(source, F.lit(pattern))
    if isinstance(target, T.StringType):
        return source
    return source.try_cast(target)


def parse_all(schema: T.StructType, patterns: Mapping[str, str] | None = None) -> list[Column]:
    """One parsed column per field, for a single ``select``."""
    patterns = patterns or {}
    return [parse(f.name, f.dataType, patterns.get(f.name)).alias(f.name) for f in schema.fields]
