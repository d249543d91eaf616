"""Grouped statistics over result rows: per entity, per category, and the enriched outcome row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rondel.functions.conditions import count_where, maybe_round, pick, ratio


def averages(columns: Mapping[str, str | Column], digits: int | None = None) -> list[Column]:
    """Mean of each column or expression, under the given names."""
    return [maybe_round(F.avg(c), digits).alias(name) for name, c in columns.items()]


def group_count_avg(df: DataFrame, keys: Sequence[str], value: str | Column, *,
                    count_name: str = "n", avg_name: str = "avg_value") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count_name), F.avg(value).alias(avg_name))


def entity_period_stats(df: DataFrame, *, entity: str, period: Sequence[str], won: Column,
                        means: Mapping[str, str | Column], entity_name: str = "entity") -> DataFrame:
    """Rows played, rows won, win rate and means, per entity and period."""
    grouped = df.groupBy(F.col(entity).alias(entity_name), *period).agg(
        F.count("*").alias("played"), count_where(won).alias("won"), *averages(means),
    )
    return grouped.withColumn("win_rate", ratio(F.col("won"), F.col("played")))


def category_month_stats(df: DataFrame, *, keys: Sequence[str], means: Mapping[str, str | Column],
                         distinct: Mapping[str, str]) -> DataFrame:
    """Row count, means and exact distinct counts per category and calendar slot."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("played"),
        *averages(means),
        *[F.count_distinct(c).alias(name) for name, c in distinct.items()],
    )


def outcome_enrich(df: DataFrame, *, first_won: Column, pairs: Mapping[str, tuple[str, str]],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Resolve side-1/side-2 columns into winner and loser columns.

    ``pairs`` maps a suffix to its two columns: ``{"name": ("team_1", "team_2")}`` gives
    ``winner_name`` and ``loser_name``. A null ``first_won`` counts as a win of side 2.
    """
    sides = [
        column
        for suffix, (one, two) in pairs.items()
        for column in (
            pick(first_won, F.col(one), F.col(two)).alias(f"winner_{suffix}"),
            pick(first_won, F.col(two), F.col(one)).alias(f"loser_{suffix}"),
        )
    ]
    return df.select(*(keep or df.columns), *sides)


def win_rate_by_group(df: DataFrame, *, by: str, first: str, second: str, digits: int | None = 3) -> DataFrame:
    """Total wins of both sides per group and the first side's share of decided rows."""
    totals = df.groupBy(by).agg(F.sum(first).alias("first_wins"), F.sum(second).alias("second_wins"))
    share = ratio(F.col("first_wins"), F.col("first_wins") + F.col("second_wins"))
    return totals.withColumn("first_win_rate", maybe_round(share, digits))


def top_groups(df: DataFrame, *, by: str, amount: str, name: str = "total") -> DataFrame:
    """Groups by summed amount, largest first; equal totals are ordered by name."""
    return df.groupBy(by).agg(F.sum(amount).alias(name)).orderBy(F.desc(name), by)


def avg_by_group(df: DataFrame, *, by: str, means: Mapping[str, str], weight: str | None = None,
                 digits: int | None = 2) -> DataFrame:
    """Mean of already averaged columns per group.

    Without ``weight`` every input row counts once, as in a plain mean of means; with it each
    mean counts for the rows it was taken over.
    """
    if weight is None:
        return df.groupBy(by).agg(*averages(means, digits))
    # a row whose mean is null must not add its weight either
    weighted = [
        maybe_round(
            F.try_divide(F.sum(F.col(c) * F.col(weight)), F.sum(F.when(F.col(c).isNotNull(), F.col(weight)))),
            digits,
        ).alias(name)
        for name, c in means.items()
    ]
    return df.groupBy(by).agg(*weighted)
