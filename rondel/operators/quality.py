"""Typed cleaning, contract checks, rejects and deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rondel.functions.casts import parse, parse_all


def _matching(names: Sequence[str], prefix: str) -> Column:
    """Equal in all of ``names``, with nulls equal to each other; the other side's columns have ``prefix``."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in names])


def _first_by_place(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The filter on ``row_number`` is pushed below the shuffle as a per-task group limit, so a key holding a third of the
    rows reaches its reducer as one row per map task."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first under the columns ``order_by`` (nulls first), or under all other columns if none are given.
    What ties under ``order_by`` is ordered by the other columns, too.

    Without an order a row's other columns are compared as one value, combined per map task: rows are brought together by their key,
    never sorted by all columns. With one, there are two phases: the first sees keys and order columns only and picks the winners,
    the second takes their rows by a hash join on keys and order; only rows that tie go through a window. ``df`` is then read
    twice: store it first where it is costly to make.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if not order_by:
        if not rest:
            return df.dropDuplicates(list(keys))
        best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_best"))
        return best.select(*[F.col(c if c in keys else f"_best.{c}") for c in df.columns])
    narrow = [*keys, *order_by]
    counted = df.groupBy(*narrow).agg(F.count("*").alias("_n"))
    won = counted.groupBy(*keys).agg(F.min(F.struct(*order_by, "_n")).alias("_best"))
    won = won.select(*[F.col(c).alias(f"_w_{c}") for c in keys], *[F.col(f"_best.{c}").alias(f"_w_{c}") for c in order_by], "_best._n")
    alone, tied = (df.join(won.filter(which).hint("shuffle_hash"), _matching(narrow, "_w_"), "left_semi")
                   for which in ("_n = 1", "_n > 1"))
    return alone.unionByName(_first_by_place(tied, keys, [*order_by, *rest]))


def parse_rules(schema: T.StructType, patterns: Mapping[str, str] | None = None,
                required: Sequence[str] = ()) -> dict[str, Column]:
    """Contract over a raw text table.

    Every typed field must parse where it is present; every required field must be present.
    """
    patterns = patterns or {}
    rules: dict[str, Column] = {}
    for field in schema.fields:
        raw = F.col(field.name)
        if field.name in required:
            rules[f"{field.name}_present"] = raw.isNotNull()
        if not isinstance(field.dataType, T.StringType):
            parsed = parse(field.name, field.dataType, patterns.get(field.name))
            rules[f"{field.name}_parses"] = raw.isNull() | parsed.isNotNull()
    return rules


def contract_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violations per rule, all counted in one pass. A null outcome is a violation."""
    names = list(rules)
    counted = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(~F.coalesce(rules[n], F.lit(False))).alias(f"v{i}") for i, n in enumerate(names)],
    )
    entries = F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("violations")) for i, n in enumerate(names)
    ])
    return counted.select("rows", F.explode(entries).alias("e")).select(
        "e.rule", "rows", "e.violations",
        F.when(F.col("e.violations") == 0, "OK").otherwise("VIOLATED").alias("status"),
    )


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks, in rule order."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]))


def silver_balance(raw: DataFrame, schema: T.StructType, *, required: Sequence[str], natural_key: Sequence[str],
                   measures: Sequence[str] = (), patterns: Mapping[str, str] | None = None) -> DataFrame:
    """Where the rows of ``raw`` end up in ``silver_clean``: kept, incomplete, or a further copy of a key.

    One pass; per key only a count is shuffled, combined per map task first.
    """
    complete = F.lit(True)
    for name in (*required, *measures):
        complete = complete & F.col(name).isNotNull()
    typed = raw.select(*parse_all(schema, patterns)).withColumn("_complete", complete)
    keys = [F.when(F.col("_complete"), F.col(k)).alias(f"_key{i}") for i, k in enumerate(natural_key)]
    copies = typed.groupBy("_complete", *keys).agg(F.count("*").alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("bronze_rows"),
        F.count_if("_complete").alias("silver_rows"),
        F.coalesce(F.sum(F.when(~F.col("_complete"), F.col("_n"))), F.lit(0)).alias("incomplete_rows"),
        F.coalesce(F.sum(F.when(F.col("_complete"), F.col("_n") - 1)), F.lit(0)).alias("duplicate_rows"),
    )


def rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break a rule, unchanged, with the rules they break."""
    return df.withColumn("reasons", broken_rules(rules)).filter(F.size("reasons") > 0)


def silver_clean(raw: DataFrame, schema: T.StructType, *, required: Sequence[str], natural_key: Sequence[str],
                 measures: Sequence[str] = (), derived: Mapping[str, Column] | None = None,
                 patterns: Mapping[str, str] | None = None,
                 order_by: Sequence[str] = ()) -> DataFrame:
    """Typed, complete, de-duplicated rows from an all-text table.

    Rows lacking a required field or a measure go first, so that a damaged copy of a key can
    never displace a sound one; ``derived`` columns see the typed values.
    """
    typed = raw.select(*parse_all(schema, patterns)).dropna(subset=[*required, *measures])
    unique = keep_first(typed, natural_key, order_by)
    return unique.select("*", *[c.alias(n) for n, c in derived.items()]) if derived else unique
