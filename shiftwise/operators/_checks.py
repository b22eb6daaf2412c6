"""Checks that need no job: input sizes that gate broadcasts, key rules that
are asserted inside the plan."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 64 << 20  # of input read by the side that is broadcast


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables and files that feed ``df``, as the planner knows them
    before anything runs (a source of unknown size counts as huge)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes()))
               for i in range(leaves.size()))


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when the input that feeds ``df`` is at most
    ``max_bytes``, else ``df`` unchanged (both sides are shuffled and adaptive
    execution may still convert the join from measured bytes). Starts no job."""
    return F.broadcast(df) if input_bytes(df) <= max_bytes else df


def any_null(keys: Sequence[str], prefix: str = "") -> Column:
    """True when any key is NULL."""
    out = F.lit(False)
    for k in keys:
        out = out | F.col(prefix + k).isNull()
    return out


def one_row_per_key(df: DataFrame, keys: Sequence[str], what: str,
                    null_keys: bool = False) -> DataFrame:
    """``df``, failing the running job on a repeated key (and, unless
    ``null_keys``, on a NULL key). The count runs over the partitioning and
    order a join on ``keys`` needs anyway; NULL keys that are allowed are not
    counted."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    bad = any_null(keys)
    repeated = (n > 1) & ~bad
    rule = F.when(repeated, F.raise_error(F.lit(f"{what}: repeated key {list(keys)}")))
    if not null_keys:
        rule = rule.when(bad, F.raise_error(F.lit(f"{what}: NULL in key {list(keys)}")))
    checked = df.withColumn("__checked", rule.otherwise(F.lit(True)))
    return checked.filter("__checked").drop("__checked")


def require_keys(keys) -> list:
    """Key list for an equi join; an empty list would make the join a cross
    join (every pair of rows), which these operators never do."""
    keys = list(keys)
    if not keys:
        raise ValueError("at least one join key is required (no cross joins)")
    return keys
