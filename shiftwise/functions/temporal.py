"""Time keys: half-hour report key, quarter-hour floor, reporting week."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftwise.functions._util import as_col, as_lit


def half_hour_floor(ts) -> Column:
    """Half-hour report key.

    A quarter-hour stamp whose minute is 15 or 45 moves back 15 minutes; every
    other stamp is unchanged (minute 7 stays 7). Seconds are kept. The result
    has the input's type, so a timestamp_ntz column stays timestamp_ntz.
    """
    c = as_col(ts)
    return F.when(F.minute(c).isin(15, 45), c - F.expr("INTERVAL 15 MINUTES")).otherwise(c)


def floor_minutes(ts, minutes: int = 15) -> Column:
    """Floor a timestamp to a ``minutes`` grid inside its hour, type-preserving.

    Subtracts the minutes past the grid line and the (fractional) seconds, so
    a timestamp_ntz column never passes through the session time zone.
    """
    c = as_col(ts)
    past = F.make_dt_interval(F.lit(0), F.lit(0), (F.minute(c) % minutes).cast("int"),
                              F.extract(F.lit("SECOND"), c))
    return c - past


def to_date_key(ts) -> Column:
    """Calendar date of a timestamp (or of a ``yyyy-MM-dd`` string)."""
    return F.to_date(as_col(ts))


def reporting_week(run_date) -> tuple[Column, Column]:
    """Last complete Sunday-Saturday week before ``run_date``.

    start = (next Sunday after run_date) - 14 days,
    end   = (next Saturday after run_date) - 7 days.
    On a Saturday run the window is 14 days long (kept as written).
    ``run_date`` is a date string / date or a Column, never the wall clock.
    """
    d = F.to_date(as_lit(run_date))
    start = F.date_sub(F.next_day(d, "Sun"), 14)
    end = F.date_sub(F.next_day(d, "Sat"), 7)
    return start, end
