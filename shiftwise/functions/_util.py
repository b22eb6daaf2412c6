from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Column name or Column -> Column."""
    return c if isinstance(c, Column) else F.col(c)


def as_lit(v) -> Column:
    """Python value or Column -> Column (strings become literals, not names)."""
    return v if isinstance(v, Column) else F.lit(v)
