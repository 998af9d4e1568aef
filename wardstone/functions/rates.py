"""Exact rounded ratios as column expressions.

All of them work on integer counts, so two engines give the same digits, and a
zero denominator gives NULL rather than an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def integer_div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0)))


def rate_pct(numerator: Column, denominator: Column) -> Column:
    """100·numerator/denominator, rounded half up to two places."""
    return integer_div(numerator * 20000 + denominator, denominator * 2) / F.lit(100.0)


def ratio_2dp(numerator: Column, denominator: Column) -> Column:
    """numerator/denominator, rounded half up to two places."""
    return integer_div(numerator * 200 + denominator, denominator * 2) / F.lit(100.0)


def fraction(numerator: Column, denominator: Column) -> Column:
    """Unrounded numerator/denominator as a double."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def count_where(condition: Column) -> Column:
    """Number of rows where the condition holds; 0, not NULL, when there are none."""
    return F.count_if(condition)


def exact(column: Column) -> Column:
    """Widen an integer so products of table-sized sums cannot overflow."""
    return column.cast("decimal(38,0)")
