"""Staffing outlook: quarter-hour forecast facts joined to the time-versioned
queue map, rolled to half-hour report rows, and combined across five metric
sources with full outer joins.

Expected inputs (column names):

* ``history``      FilterName, ViewName, QueueID, RecordStartDateInclusive,
                   RecordEndDateNonInclusive (validity-versioned queue filters)
* ``view_map``     ViewName, Partner, Site, LineOfBusiness, ServiceModel
* ``fte``          QueueID, DateTime, FTE
* ``queue``        QueueID, DateTime, AFTE
* ``volume``       QueueID, DateTime, CALLVOLUME, AHT
* ``requirement``  ViewName, DateTime, Required   (contract requirement)
* ``model``        QueueID, DateTime, Required    (model-computed requirement)
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.functions.aggregates import half_hour_mean_sum, weighted_average
from shiftwise.functions.predicates import in_range, positive
from shiftwise.functions.temporal import half_hour_floor
from shiftwise.operators._checks import BROADCAST_MAX_BYTES, broadcast_if_small, input_bytes
from shiftwise.operators.combine import full_outer_chain
from shiftwise.operators.validity import validity_join
from shiftwise.session import scratch_path
from shiftwise.sources.sinks import write_clustered

# Fixed values of the report contract.
REPORT_KEYS = ["DateTime", "ViewName", "Partner", "Site", "LineOfBusiness", "ServiceModel"]
MAP_ATTRS = ["Partner", "Site", "LineOfBusiness", "ServiceModel"]
METRICS = ["ForecastRequired", "ForecastFTE", "ForecastVolume", "ForecastAHT",
           "ContractRequired", "ErlangRequired"]
OUTPUT_DDL = ("DateTime timestamp_ntz, ViewName string, Partner string, Site string, "
              "LineOfBusiness string, ServiceModel string, ForecastRequired double, "
              "ForecastFTE double, ForecastVolume double, ForecastAHT double, "
              "ContractRequired double, ErlangRequired double, DateCreated timestamp_ntz")
START_COL = "RecordStartDateInclusive"
END_COL = "RecordEndDateNonInclusive"


def queue_versions(history: DataFrame, filter_names: Sequence[str]) -> DataFrame:
    """Queue versions of the wanted filters."""
    return history.filter(F.col("FilterName").isin(list(filter_names))).select(
        "QueueID", "ViewName", START_COL, END_COL)


def queue_filter_map(history: DataFrame, view_map: DataFrame,
                     filter_names: Sequence[str]) -> DataFrame:
    """Queue versions of the wanted filters, with the view's attributes.

    Inner join on ViewName: a view with several map rows yields several rows
    (the lookup replaces a table-valued split function)."""
    return (queue_versions(history, filter_names)
            .join(view_map.select("ViewName", *MAP_ATTRS), "ViewName", "inner")
            .select("QueueID", "ViewName", *MAP_ATTRS, START_COL, END_COL))


def _choose_strategy(history: DataFrame, view_map: DataFrame, strategy: str,
                     max_bytes: int) -> str:
    if strategy != "auto":
        return strategy
    return "broadcast" if input_bytes(history) + input_bytes(view_map) <= max_bytes else "binned"


def fact_stage(facts: DataFrame, fmap: DataFrame, start, end, guard: str | None,
               aggs: list, half_hour: bool = True, strategy: str = "broadcast",
               lookup: DataFrame | None = None, **options) -> DataFrame:
    """Validity-join one quarter-hour fact source to the queue map and roll it up.

    Rows outside ``[start, end]`` (end inclusive, midnight) and - when
    ``guard`` is set - rows whose guard value is NULL or not positive are
    dropped before the join. Grouped by the half-hour key (or the raw stamp
    when ``half_hour`` is False) and the view attributes. With
    ``lookup`` (the view map) ``fmap`` holds the queue versions alone, and facts meet
    the view's attributes in a second join. ``options`` go to ``validity_join``.
    """
    cond = in_range("DateTime", start, end)
    if guard:
        cond = cond & positive(guard)
    joined = validity_join(facts.filter(cond), fmap, ["QueueID"], "DateTime",
                           START_COL, END_COL, strategy=strategy, clip=(start, end), **options)
    if lookup is not None:
        joined = joined.join(lookup, "ViewName", "inner")
    ts = half_hour_floor(F.col("DateTime")) if half_hour else F.col("DateTime")
    return joined.groupBy(ts.alias("DateTime"), "ViewName", *MAP_ATTRS).agg(*aggs)


def contract_stage(requirement: DataFrame, view_map: DataFrame, start, end,
                   cutoff=None) -> DataFrame:
    """Contract requirement per view, NOT aggregated: duplicate rows stay rows."""
    r = requirement.filter(in_range("DateTime", start, end, cutoff) & positive("Required"))
    return (r.join(view_map.select("ViewName", *MAP_ATTRS), "ViewName", "inner")
            .select("DateTime", "ViewName", *MAP_ATTRS,
                    F.col("Required").alias("ContractRequired")))


def staffing_outlook(history: DataFrame, view_map: DataFrame, fte: DataFrame, queue: DataFrame,
                     volume: DataFrame, requirement: DataFrame, model: DataFrame,
                     start, end, filter_names: Sequence[str], cutoff=None,
                     zero_fill: bool = False, now=None, strategy: str = "auto",
                     broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
                     queue_map: DataFrame | None = None) -> DataFrame:
    """The half-hour staffing outlook report.

    Output columns: ``REPORT_KEYS``, the six ``METRICS`` as double, and
    ``DateCreated`` (``now``; defaults to the query's current timestamp).
    ``zero_fill`` replaces missing metrics with 0. ``cutoff`` adds
    ``DateTime < cutoff`` to the contract stage only. ``queue_map`` passes a
    prebuilt (e.g. persisted) ``queue_filter_map`` result.
    """
    # Sizes come from the planner: building the report starts no job.
    strat = _choose_strategy(history, view_map, strategy, broadcast_max_bytes)
    view_map = broadcast_if_small(view_map.select("ViewName", *MAP_ATTRS), broadcast_max_bytes)
    lookup = None
    if queue_map is not None:
        fmap = queue_map
    elif strat == "broadcast":
        # What is shipped are the two tables whose bytes are known, not their join,
        # which has a row for every map row of every version of a view.
        fmap = queue_versions(history, filter_names)
        lookup = F.broadcast(view_map)
    else:
        fmap = queue_filter_map(history, view_map, filter_names)

    fr = fact_stage(fte, fmap, start, end, "FTE",
                    [half_hour_mean_sum("FTE").alias("ForecastRequired")], strategy=strat, lookup=lookup)
    fq = fact_stage(queue, fmap, start, end, "AFTE",
                    [half_hour_mean_sum("AFTE").alias("ForecastFTE")], strategy=strat, lookup=lookup)
    fv = fact_stage(volume, fmap, start, end, "CALLVOLUME",
                    [F.sum("CALLVOLUME").alias("ForecastVolume"),
                     weighted_average("AHT", "CALLVOLUME").alias("ForecastAHT")],
                    strategy=strat, lookup=lookup)
    cr = contract_stage(requirement, view_map, start, end, cutoff)
    er = fact_stage(model, fmap, start, end, None,
                    [F.sum("Required").alias("ErlangRequired")], half_hour=False,
                    strategy=strat, lookup=lookup)

    # fr, fq, fv, er are grouped by exactly the report keys (one row per key);
    # the contract stage is not, so it is joined, not merged.
    report = full_outer_chain([fr, fq, fv, cr, er], REPORT_KEYS,
                              zero_fill=METRICS if zero_fill else (),
                              unique=[True, True, True, False, True])
    now_c = F.current_timestamp() if now is None else F.lit(now)
    return report.select(
        F.col("DateTime").cast("timestamp_ntz").alias("DateTime"),
        *[F.col(c) for c in REPORT_KEYS[1:]],
        *[F.col(m).cast("double").alias(m) for m in METRICS],
        now_c.cast("timestamp_ntz").alias("DateCreated"))


def run_staffing_outlook(target: str, history: DataFrame, view_map: DataFrame, fte: DataFrame,
                         queue: DataFrame, volume: DataFrame, requirement: DataFrame,
                         model: DataFrame, start, end, filter_names: Sequence[str],
                         mode: str = "overwrite",
                         cluster_by: Sequence[str] = ("DateTime", "ViewName"),
                         names: Mapping[str, str] | None = None, **options) -> None:
    """Build the report and replace ``target`` with it, clustered by
    ``cluster_by`` (truncate-and-insert plus the layout the unique index gave).
    ``names`` renames result columns (then ``cluster_by`` uses the new names).

    The queue map feeds four stages: it is persisted (memory, spilling to disk;
    lost blocks are recomputed from lineage), counted, and released afterwards.
    With ``strategy="auto"`` its measured size decides whether it is shipped to all
    tasks. The report is stored once before it is clustered: the range partitioner
    reads its input twice, to sample it and to deal it.
    """
    strategy = options.pop("strategy", "auto")
    limit = options.get("broadcast_max_bytes", BROADCAST_MAX_BYTES)
    fmap = queue_filter_map(history, view_map, filter_names).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fmap.count()
        if strategy == "auto":
            strategy = "broadcast" if input_bytes(fmap.select("*")) <= limit else "binned"
        report = staffing_outlook(history, view_map, fte, queue, volume, requirement, model,
                                  start, end, filter_names, queue_map=fmap, strategy=strategy, **options)
        path = scratch_path(report.sparkSession, "outlook-report")
        report.withColumnsRenamed(dict(names or {})).write.parquet(path)
        stored = report.sparkSession.read.parquet(path)
        write_clustered(stored, target, list(cluster_by), mode=mode)
    finally:
        fmap.unpersist()
