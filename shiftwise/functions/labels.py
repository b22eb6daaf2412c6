"""Code-to-label maps as CASE expressions (small, literal mappings only)."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftwise.functions._util import as_col


def label_map(col, mapping: Mapping, default=None) -> Column:
    """``CASE col WHEN k1 THEN v1 ... [ELSE default] END``; unmatched -> NULL
    unless ``default`` is given."""
    c = as_col(col)
    items = list(mapping.items())
    if not items:
        return F.lit(default)
    expr = None
    for k, v in items:
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def relabel(col, mapping: Mapping) -> Column:
    """Replace listed values, pass every other value (and NULL) through."""
    c = as_col(col)
    items = list(mapping.items())
    if not items:
        return c
    expr = None
    for k, v in items:
        expr = F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v))
    return expr.otherwise(c)
