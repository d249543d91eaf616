"""Conditional measures and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` is true; 0, not null, when there are none."""
    return F.count_if(condition)


def share_where(condition: Column) -> Column:
    """Fraction of rows for which ``condition`` is true; null counts as false."""
    return F.avg(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def pick(condition: Column, when_true: Column, when_false: Column) -> Column:
    """Two-way choice in which a null condition takes the second branch."""
    return F.when(condition, when_true).otherwise(when_false)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, null for a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def gap(left: Column, right: Column) -> Column:
    return F.abs(left - right)


def maybe_round(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)
