"""Range helpers kept inside the plan (scalar subqueries, no driver fetch)."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.predicates import outside_bounds, within_windows


def stage_bounds(stage: DataFrame, col: str, lo_alias: str = "min_value",
                 hi_alias: str = "max_value") -> DataFrame:
    """One row: ``min(col)``, ``max(col)`` in a single pass (NULLs when empty)."""
    return stage.agg(F.min(col).alias(lo_alias), F.max(col).alias(hi_alias))


def rows_outside_stage(target: DataFrame, ts: str, stage: DataFrame, stage_ts: str) -> DataFrame:
    """Target rows with ``ts`` before the stage minimum or after its maximum.

    The bounds are scalar subqueries evaluated once on the cluster and pushed
    into the target scan as literals; nothing is collected.
    """
    lo = stage.select(F.min(stage_ts)).scalar()
    hi = stage.select(F.max(stage_ts)).scalar()
    return target.filter(outside_bounds(ts, lo, hi))


def exclude_windows(df: DataFrame, ts: str, windows: Iterable[Sequence]) -> DataFrame:
    """Drop rows whose ``ts`` lies in any inclusive ``(lo, hi)`` window (rows
    with a NULL ``ts`` are dropped too, as ``NOT (NULL)`` is not true)."""
    return df.filter(~within_windows(ts, list(windows)))


def duplicate_keys(df: DataFrame, keys: Sequence[str], alias: str = "n_rows") -> DataFrame:
    """Key values held by more than one row, with their row count - the check
    a unique index on ``keys`` would enforce. Counting is a partial aggregate,
    so a heavily repeated key costs one row per task before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)).filter(F.col(alias) > 1)
