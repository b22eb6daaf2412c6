"""Grouped roll-ups: half-hour sums, re-aggregation, two-level distinct counts."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.aggregates import half_hour_mean_sum
from shiftwise.functions.temporal import half_hour_floor


def half_hour_sum(df: DataFrame, ts: str, keys: Sequence[str], value: str, alias: str,
                  ts_alias: str = "DateTime", divisor: float = 2.0) -> DataFrame:
    """``GROUP BY half_hour_floor(ts), keys`` with ``sum(value) / divisor``."""
    return (df.groupBy(half_hour_floor(F.col(ts)).alias(ts_alias), *keys)
            .agg(half_hour_mean_sum(value, divisor).alias(alias)))


def reaggregate_half_hour(df: DataFrame, ts: str, keys: Sequence[str], value: str, alias: str,
                          ts_alias: str = "DateTime", divisor: float = 2.0) -> DataFrame:
    """Sum per quarter-hour stamp first, then roll those sums up to half hours."""
    quarter = df.groupBy(F.col(ts).alias(ts_alias), *keys).agg(F.sum(value).alias("__q"))
    return half_hour_sum(quarter, ts_alias, keys, "__q", alias, ts_alias=ts_alias, divisor=divisor)


def two_level_count(frames: Sequence[DataFrame], keys: Sequence[str], id_col: str,
                    alias: str) -> DataFrame:
    """Distinct ``id_col`` count per key within each frame, summed across frames
    (an id present in two frames counts twice): the distinct (frame, id) pairs
    of the union, in one aggregation."""
    keys = list(keys)
    tagged = [f.select(*keys, F.lit(i).alias("__frame"), F.col(id_col).alias("__id"))
              for i, f in enumerate(frames)]
    merged = reduce(lambda a, b: a.unionByName(b), tagged)
    return merged.groupBy(*keys).agg(F.countDistinct("__frame", "__id").alias(alias))
