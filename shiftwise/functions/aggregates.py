"""Aggregate expressions. All are algebraic (sum / count based), so Spark
computes them with a map-side partial aggregate before any shuffle - a hot
group is pre-reduced in every task instead of landing whole on one reducer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftwise.functions._util import as_col


def half_hour_mean_sum(value, divisor: float = 2.0) -> Column:
    """``sum(value) / 2.0``: quarter-hour staffing values summed into a half
    hour and halved, even when only one quarter is present."""
    return F.sum(as_col(value)) / F.lit(float(divisor))


def weighted_average(value, weight) -> Column:
    """``sum(weight * value) / nullif(sum(weight), 0)`` as double.

    Rows with a NULL value still add their weight to the divisor (SQL sum
    semantics); a zero total weight gives NULL instead of an ANSI error.
    """
    v, w = as_col(value), as_col(weight)
    return (F.sum(w * v) / F.nullif(F.sum(w), F.lit(0))).cast("double")


def ratio_of_sums(numerator, denominator) -> Column:
    """``sum(numerator) / nullif(sum(denominator), 0)`` as double."""
    return (F.sum(as_col(numerator)) / F.nullif(F.sum(as_col(denominator)), F.lit(0))).cast("double")


def count_where(cond: Column) -> Column:
    """Rows where ``cond`` is TRUE (NULL counts 0), as bigint."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def count_unless(cond: Column) -> Column:
    """Rows where ``cond`` is not TRUE (NULL counts 1), as bigint."""
    return F.sum(F.when(cond, F.lit(0)).otherwise(F.lit(1))).cast("bigint")
