"""Forecast slot report: a five-table join down to base forecast series,
then the 96 quarter-hour AHT / call-volume columns turned into rows.

Expected inputs: ``campaigns`` (ID, NAME), ``plans`` (ID, CAMPAIGNID),
``instances`` (ID, SPID, ISBASE), ``series`` (FORECASTINSTANCEID, SQUEUEID,
DATETIME, AHT1..AHTn, CALLVOLUME1..CALLVOLUMEn), ``queues`` (ID, NAME).
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.predicates import in_range
from shiftwise.operators._checks import broadcast_if_small
from shiftwise.operators.bounds import exclude_windows
from shiftwise.operators.combine import enrich
from shiftwise.operators.reshape import slot_columns, unpivot_slots

ID_COLS = ["CampaignID", "CampaignName", "QueueID", "QueueName", "BaseDateTime"]


def base_series(campaigns: DataFrame, plans: DataFrame, instances: DataFrame,
                series: DataFrame, queues: DataFrame, start, end,
                n_slots: int = 96) -> DataFrame:
    """Series of base instances inside ``[start, end]`` with the names of their
    campaign and queue; wide rows with ``AHTi`` / ``CallVolumei``.

    Every table is first projected to the names of the result. Owner and queue
    lookups are sent to the tasks of the series scan when they are small, so
    the wide rows - the only large input - are not shuffled.
    """
    campaign = campaigns.select(F.col("ID").alias("CampaignID"), F.col("NAME").alias("CampaignName"))
    plan = plans.select(F.col("ID").alias("plan"), F.col("CAMPAIGNID").alias("CampaignID"))
    instance = (instances.filter(F.col("ISBASE") == 1)
                .select(F.col("ID").alias("instance"), F.col("SPID").alias("plan")))
    queue = queues.select(F.col("ID").alias("QueueID"), F.col("NAME").alias("QueueName"))
    values = dict(zip(slot_columns("AHT", n_slots) + slot_columns("CALLVOLUME", n_slots),
                      slot_columns("AHT", n_slots) + slot_columns("CallVolume", n_slots)))
    rows = series.filter(in_range("DATETIME", start, end)).select(
        F.col("FORECASTINSTANCEID").alias("instance"), F.col("SQUEUEID").alias("QueueID"),
        F.col("DATETIME").alias("BaseDateTime"), *[F.col(c).alias(v) for c, v in values.items()])
    owner = enrich(enrich(instance, plan, ["plan"]), campaign, ["CampaignID"]).drop("plan")
    named = enrich(enrich(rows, broadcast_if_small(owner), ["instance"]),
                   broadcast_if_small(queue), ["QueueID"])
    return named.select(*ID_COLS, *values.values())


def slot_rows(wide: DataFrame, ids: Sequence[str], n_slots: int = 96,
              base_ts: str = "BaseDateTime", aht_prefix: str = "AHT",
              volume_prefix: str = "CallVolume", minutes: int = 15,
              windows: Iterable[Sequence] = (), window_col: str | None = None) -> DataFrame:
    """Un-pivot to one row per slot, keep ``CallVolume >= 0`` (NULL volume is
    dropped), and drop rows whose ``window_col`` (default: the base stamp)
    falls in any excluded window."""
    long = unpivot_slots(wide, ids, {"AHT": slot_columns(aht_prefix, n_slots),
                                     "CallVolume": slot_columns(volume_prefix, n_slots)},
                         base_ts=base_ts, minutes=minutes)
    long = long.filter(F.col("CallVolume") >= 0)
    windows = list(windows)
    if windows:
        long = exclude_windows(long, window_col or base_ts, windows)
    return long


def slot_report(campaigns, plans, instances, series, queues, start, end, n_slots: int = 96,
                windows: Iterable[Sequence] = (), window_col: str | None = None) -> DataFrame:
    wide = base_series(campaigns, plans, instances, series, queues, start, end, n_slots)
    return slot_rows(wide, ID_COLS, n_slots, windows=windows, window_col=window_col)
