"""Queries of this subpackage, kept apart from those of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without ``sql`` a test holds it against a brute-force version."""
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return add
