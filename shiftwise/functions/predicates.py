"""Predicates as Column builders."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftwise.functions._util import as_col, as_lit


def in_range(ts, start, end, cutoff=None) -> Column:
    """``ts BETWEEN start AND end`` (both ends inclusive), optional ``ts < cutoff``.

    Bounds given as date strings are coerced to the column's type, so an end of
    ``'2025-08-31'`` against a timestamp means midnight of that day, inclusive.
    """
    c = as_col(ts)
    cond = c.between(as_lit(start), as_lit(end))
    if cutoff is not None:
        cond = cond & (c < as_lit(cutoff))
    return cond


def positive(value) -> Column:
    """``value IS NOT NULL AND value > 0``."""
    c = as_col(value)
    return c.isNotNull() & (c > 0)


def valid_label(col, banned="", separator: str = ",") -> Column:
    """Non-empty label that is not a banned value and holds no separator.

    NULL labels fail (``length(NULL) > 0`` is NULL). ``banned`` may be one value
    or a list of values.
    """
    c = as_col(col)
    cond = F.length(c) > 0
    if isinstance(banned, (list, tuple, set)):
        if banned:
            cond = cond & ~c.isin(list(banned))
    elif banned is not None and banned != "":
        cond = cond & (c != F.lit(banned))
    if separator:
        cond = cond & ~c.contains(separator)
    return cond


def within_interval(ts, start, end) -> Column:
    """Half-open containment ``start <= ts < end``; NULL bounds never contain."""
    c = as_col(ts)
    return (c >= as_col(start)) & (c < as_col(end))


def outside_bounds(ts, lo, hi) -> Column:
    """``ts < lo OR ts > hi``."""
    c = as_col(ts)
    return (c < as_lit(lo)) | (c > as_lit(hi))


def within_windows(ts, windows: Iterable[Sequence]) -> Column:
    """True when ``ts`` falls in any of the inclusive ``(lo, hi)`` windows."""
    c = as_col(ts)
    conds = [c.between(as_lit(lo), as_lit(hi)) for lo, hi in windows]
    if not conds:
        return F.lit(False)
    return reduce(lambda a, b: a | b, conds)


def changed(left: Sequence, right: Sequence, null_safe: bool = False) -> Column:
    """Any attribute differs.

    Default (as in the reference update rule): plain ``!=``, so a NULL on either
    side never counts as a change. ``null_safe=True`` treats NULL vs value as a
    change and NULL vs NULL as equal.
    """
    pairs = list(zip(left, right))
    if not pairs:
        return F.lit(False)
    if null_safe:
        parts = [~as_col(a).eqNullSafe(as_col(b)) for a, b in pairs]
    else:
        parts = [F.coalesce(as_col(a) != as_col(b), F.lit(False)) for a, b in pairs]
    return reduce(lambda a, b: a | b, parts)


def nullness_changed(left: Sequence, right: Sequence) -> Column:
    """Any attribute is NULL on exactly one side."""
    parts = [as_col(a).isNotNull() != as_col(b).isNotNull() for a, b in zip(left, right)]
    if not parts:
        return F.lit(False)
    return reduce(lambda a, b: a | b, parts)
