"""Exact comparison of a Spark result with a DuckDB result, independent of row and column order."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, Decimal)):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return datetime.datetime(value.year, value.month, value.day).isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql):
    """An empty list if both sides agree, else a few differing rows of each side."""
    relation = con.sql(sql)
    theirs_names = list(relation.columns)
    names = spark_df.columns
    if sorted(names) != sorted(theirs_names):
        return [f"columns {sorted(names)} != {sorted(theirs_names)}"]
    ours, theirs = rows_of(names, spark_df.collect()), rows_of(theirs_names, relation.fetchall())
    if ours == theirs:
        return []
    return [f"rows {sum(ours.values())} / {sum(theirs.values())}",
            f"only spark {list((ours - theirs).items())[:3]}", f"only sql {list((theirs - ours).items())[:3]}"]


SQL_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def type_differences(spark_df, con, sql):
    relation = con.sql(sql)
    theirs = {n: SQL_TYPES.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    ours = dict(spark_df.dtypes)
    return {n: (ours.get(n), t) for n, t in theirs.items() if ours.get(n) != t}
