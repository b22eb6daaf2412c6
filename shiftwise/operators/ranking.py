"""Latest row per key."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.functions._util import as_col


def latest_per_key(df: DataFrame, keys: Sequence, order_by: Sequence,
                   tie_break: Sequence = ()) -> DataFrame:
    """Keep the first row per key under ``order_by`` then ``tie_break``, all
    descending with NULLs last (the latest non-NULL value wins).

    ``row_number() = 1`` is planned by Spark as a ``WindowGroupLimit``: every
    map task keeps only its local top row per key before the shuffle, so a key
    holding a large share of the rows costs one row per task downstream.
    Give ``tie_break`` columns that make the order total for a deterministic
    answer.
    """
    order = [as_col(c).desc_nulls_last() for c in list(order_by) + list(tie_break)]
    w = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1)
            .drop("__rn"))
