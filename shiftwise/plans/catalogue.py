"""Query catalogue: each entry runs one operator or job on the driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names and types match the SQL of the same name in
``shiftwise.plans.oracle``. Double columns are rounded to 6 decimals in both,
so sums taken in a different order compare equal.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from shiftwise.functions.aggregates import half_hour_mean_sum, ratio_of_sums, weighted_average
from shiftwise.functions.labels import label_map
from shiftwise.functions.predicates import in_range, positive, valid_label
from shiftwise.functions.temporal import half_hour_floor, reporting_week
from shiftwise.operators import (
    backfill,
    enrich,
    exclude_windows,
    latest_per_key,
    new_rows,
    project_schema,
    reaggregate_half_hour,
    rows_outside_stage,
    stage_bounds,
    sync,
    unpack_payload,
    validity_join,
)
from shiftwise.operators.validity import stored_hot_bins
from shiftwise.plans import analogs as A
from shiftwise.plans import domain_counts as DC
from shiftwise.plans import staffing as S
from shiftwise.plans import utilisation as U
from shiftwise.plans.payloads import read_schema_table, route_log_table
from shiftwise.plans.presets import OUTLOOK_CLUSTER_BY, OUTLOOK_OUTPUT
from shiftwise.plans.slots import slot_report, slot_rows
from shiftwise.plans.synchronise import read_partitioned, sync_partitions, sync_table, write_partitioned
from shiftwise.session import scratch_path
from shiftwise.sources.readers import equal_depth_cuts, jdbc_cut_predicates, read_source
from shiftwise.sources.sinks import write_clustered, write_interleaved, write_table

Query = Callable[[SparkSession, str], DataFrame]
ROUND = 6


def round6(c) -> F.Column:
    """Round to ``ROUND`` decimals as ``round(c * 10^d) / 10^d`` (half away
    from zero on the scaled double), the same arithmetic as the SQL oracle's
    ``round(x, 6)``; decimal HALF_UP on the unscaled value differs on ties."""
    scale = float(10 ** ROUND)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def rounded(df: DataFrame) -> DataFrame:
    """Round every floating-point column to ``ROUND`` decimals."""
    return df.select(*[round6(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _fmap(spark, d):
    return S.queue_filter_map(A.history(spark, d), A.view_map(spark, d), A.FILTER_NAMES)


def _all_facts(spark, d):
    return A.fact15(spark, d).select("QueueID", "DateTime", F.col("value").alias("FTE"),
                                     F.col("aht").alias("AHT"))


# --- staffing outlook family ---------------------------------------------------

def q_validity_join(spark, d, strategy="auto", **options):
    facts = _all_facts(spark, d)
    out = S.fact_stage(facts, _fmap(spark, d), A.REPORT_START, A.REPORT_END, "FTE",
                       [half_hour_mean_sum("FTE").alias("ForecastRequired")], strategy=strategy, **options)
    return rounded(out)


def q_validity_join_binned(spark, d):
    return q_validity_join(spark, d, strategy="binned")


def _split_join(spark, d, strategy):
    # Queues with more than 500 facts in the report range are split.
    facts = _all_facts(spark, d).filter(in_range("DateTime", A.REPORT_START, A.REPORT_END) & positive("FTE"))
    hot = stored_hot_bins(facts, ["QueueID"], "DateTime", hot_rows=500)
    return q_validity_join(spark, d, strategy=strategy, hot=hot)


def q_validity_join_adaptive(spark, d):
    return _split_join(spark, d, "adaptive")


def q_validity_join_merge(spark, d):
    return _split_join(spark, d, "merge")


def q_half_hour_floor(spark, d):
    f = A.fact15(spark, d)
    return f.select("event_id", "ts", half_hour_floor("ts").alias("half_hour_raw"),
                    "DateTime", half_hour_floor("DateTime").alias("half_hour"))


def q_range_filter_inclusive(spark, d):
    o = A.table(spark, d, "orders")
    return o.filter(in_range("o_orderdate", "1996-01-01", "1996-12-31")).select(
        "o_orderkey", "o_orderdate", "o_totalprice")


def _volume_join(spark, d):
    facts = _all_facts(spark, d).withColumnRenamed("FTE", "CALLVOLUME")
    facts = facts.filter(in_range("DateTime", A.REPORT_START, A.REPORT_END)
                         & positive("CALLVOLUME"))
    return validity_join(facts, _fmap(spark, d), ["QueueID"], "DateTime",
                         clip=(A.REPORT_START, A.REPORT_END))


def q_weighted_average(spark, d):
    j = _volume_join(spark, d)
    out = j.groupBy(half_hour_floor("DateTime").alias("DateTime"), *S.REPORT_KEYS[1:]).agg(
        F.sum("CALLVOLUME").alias("ForecastVolume"),
        weighted_average("AHT", "CALLVOLUME").alias("ForecastAHT"))
    return rounded(out)


def q_ratio_of_sums(spark, d):
    j = _volume_join(spark, d)
    out = j.groupBy(half_hour_floor("DateTime").alias("DateTime"), *S.REPORT_KEYS[1:]).agg(
        ratio_of_sums("CALLVOLUME", "AHT").alias("VolumePerHandleSecond"))
    return rounded(out)


def q_reaggregate_half_hour(spark, d):
    # USING join on the queue id with the interval as a post-join filter,
    # quarter-hour sums, then half-hour sums of those.
    facts = _all_facts(spark, d).filter(positive("FTE"))
    j = facts.join(_fmap(spark, d), "QueueID", "inner").filter(
        (F.col("RecordStartDateInclusive") <= F.col("DateTime"))
        & (F.col("RecordEndDateNonInclusive") > F.col("DateTime")))
    out = reaggregate_half_hour(j, "DateTime", S.REPORT_KEYS[1:], "FTE", "ForecastFTE")
    return rounded(out)


def q_lookup_join(spark, d):
    return _fmap(spark, d)


def q_contract_cutoff(spark, d):
    out = S.contract_stage(A.contract_orders(spark, d), A.view_map(spark, d),
                           "1996-01-01", "1998-12-31", cutoff="1998-07-01")
    return rounded(out)


def _outlook(spark, d, zero_fill):
    return S.staffing_outlook(
        A.history(spark, d), A.view_map(spark, d), A.fte(spark, d), A.afte(spark, d),
        A.volume(spark, d), A.requirement(spark, d), A.model_required(spark, d),
        A.REPORT_START, A.REPORT_END, A.FILTER_NAMES, zero_fill=zero_fill, now=A.NOW)


def q_staffing_outlook(spark, d):
    return rounded(_outlook(spark, d, False))


def q_staffing_outlook_zero_fill(spark, d):
    return rounded(_outlook(spark, d, True))


def q_exclude_windows(spark, d):
    f = A.fact15(spark, d)
    out = exclude_windows(f, "ts", [("2024-01-10 02:00:00", "2024-01-10 02:45:00"),
                                    ("2024-01-20 04:00:00", "2024-01-20 04:45:00")])
    return rounded(out.select("event_id", "ts", "value"))


def q_unpivot_slots(spark, d):
    wide = A.wide_slots(spark, d).filter(
        (F.col("BaseDateTime") >= F.lit("2024-01-02")) & (F.col("BaseDateTime") <= F.lit("2024-01-29")))
    return rounded(slot_rows(wide, ["QueueID", "BaseDateTime"], 96, volume_prefix="CALLVOLUME"))


def q_slot_report(spark, d):
    out = slot_report(*A.slot_tables(spark, d), "2024-01-02", "2024-01-29",
                      windows=[("2024-01-10 00:00:00", "2024-01-10 00:45:00")])
    return rounded(out)


def q_chain_join(spark, d):
    r, n, c, o, li = (A.table(spark, d, t) for t in
                      ("region", "nation", "customer", "orders", "lineitem"))
    j = (r.join(n, r["r_regionkey"] == n["n_regionkey"], "inner")
         .join(c, n["n_nationkey"] == c["c_nationkey"], "inner")
         .filter(F.col("c_mktsegment") == "BUILDING")
         .join(o, c["c_custkey"] == o["o_custkey"], "inner")
         .join(li, o["o_orderkey"] == li["l_orderkey"], "inner"))
    return rounded(j.select("r_name", "n_name", "c_custkey", "o_orderkey", "l_linenumber",
                            "l_quantity"))


# --- calendar, labels, filters ----------------------------------------------------

def q_reporting_week(spark, d):
    o = A.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    start, end = reporting_week(F.col("run_date"))
    return o.select("run_date", start.alias("start_date"), end.alias("end_date"))


def q_run_week(spark, d):
    # One generated row holds the run's date (here the day behind the last order) and
    # its week; orders of that week are counted.
    o = A.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    last = o.agg(F.max("day").alias("d")).select("d").scalar()
    start, end = reporting_week(F.col("run_date"))
    week = spark.range(1).select(F.date_add(last, 1).alias("run_date")).select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), start.alias("start_date"), end.alias("end_date"))
    inside = F.col("day").between(week.select("start_date").scalar(), week.select("end_date").scalar())
    n = o.filter(inside).agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return week.select("run_date", "start_date", "end_date", n.alias("orders"))


def q_load_stamp(spark, d):
    # The syncs' wall-clock stamp: one value for the whole run, taken while it ran.
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = scratch_path(spark, "stamped")
    write_table(sync(A.dim_target(spark, d), A.dim_stage(spark, d), ["CampaignID"], DIM_VALUES, "dimension",
                     F.current_timestamp()), out)
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    stamp = F.col("RecordLastModifiedDateTime")
    target = A.dim_target(spark, d).select("CampaignID", stamp.alias("was"))
    rows = spark.read.parquet(out).join(target, "CampaignID", "left")
    fresh = F.col("was").isNull() | (stamp != F.col("was"))
    return rows.groupBy(fresh.alias("stamped")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_and(~fresh | stamp.between(F.lit(before), F.lit(after))).alias("while_it_ran"),
        F.countDistinct(F.when(fresh, stamp)).alias("stamps"))


def q_valid_domain_filter(spark, d):
    p = A.table(spark, d, "part")
    cond = (valid_label("p_type", A.BANNED_DOMAIN, ",") & F.col("p_brand").isin(A.GOVERNANCE)
            & (F.col("p_size") != 50))
    return p.filter(cond).select("p_partkey", "p_type", "p_brand")


def q_code_label_map(spark, d):
    a = A.articles(spark, d)
    return a.select("id", "record_type_id",
                    label_map("record_type_id", A.RECORD_TYPES).alias("record_type_description"))


# --- utilisation family -----------------------------------------------------------

def _util_inputs(spark, d):
    return dict(clicks=A.clicks(spark, d), clicks_alt=A.clicks_alt(spark, d),
                articles=A.articles(spark, d), links=A.links(spark, d), flags=A.flags(spark, d))


def _window_cols():
    return U._window(None, A.WINDOW)


def q_utilisation_base(spark, d):
    t, (s, e) = _util_inputs(spark, d), _window_cols()
    return U.activity_base(t["clicks"], t["clicks_alt"], t["articles"], t["links"], t["flags"],
                           A.utilisation_params(), s, e)


def q_two_level_counts(spark, d):
    t, (s, e) = _util_inputs(spark, d), _window_cols()
    return U.view_counts(t["clicks"], t["clicks_alt"], A.utilisation_params(), s, e)


def q_activity_rollup(spark, d):
    t, (s, e) = _util_inputs(spark, d), _window_cols()
    return U.link_activity(t["articles"], t["links"], A.utilisation_params(), s, e)


def q_enrich_keys(spark, d):
    return enrich(q_utilisation_base(spark, d), q_two_level_counts(spark, d), U.KEYS, "inner")


def q_latest_per_key(spark, d):
    li = A.table(spark, d, "lineitem").withColumn(
        "article_number", F.col("l_partkey").cast("string"))
    top = latest_per_key(li, ["article_number"], ["l_shipdate"],
                         tie_break=["l_orderkey", "l_linenumber"])
    return top.select("article_number", F.to_date("l_shipdate").alias("link_date"),
                      "l_orderkey", "l_linenumber")


def q_backfill_latest(spark, d):
    lp = A._line_part(spark, d)
    base = lp.select(
        F.col("l_partkey").cast("string").alias("article_number"),
        F.to_date("l_shipdate").alias("date"), "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.col("p_type")).alias("product_line"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("string"))
        .otherwise(F.col("p_brand")).alias("shared_with"))
    latest = U.latest_article_attrs(A.articles(spark, d), A.links(spark, d),
                                    A.utilisation_params())
    return backfill(base, latest, ["article_number"], ["product_line", "shared_with"])


def q_score_asof_day(spark, d):
    e = A.table(spark, d, "events")
    days = e.filter(F.col("event_type") == "view").select(
        "user_id", F.to_date("ts").alias("day")).distinct()
    sc = e.filter(F.col("event_type").isin("click", "purchase")).withColumn(
        "day", F.to_date("ts"))
    top = latest_per_key(sc, ["user_id", "day"], ["ts"], tie_break=["event_id"])
    out = enrich(days, top.select("user_id", "day", F.col("value").alias("score")),
                 ["user_id", "day"], "left")
    return rounded(out)


def q_utilisation_summary(spark, d):
    t = _util_inputs(spark, d)
    out = U.utilisation_summary(t["clicks"], t["clicks_alt"], t["articles"], t["links"],
                                t["flags"], A.scores(spark, d), A.utilisation_params(),
                                window=A.WINDOW)
    return rounded(out)


# --- as-of domain counts ----------------------------------------------------------

AS_OF = "1998-06-30"
SEGMENT_RELABEL = {"AUTOMOBILE": "MOTOR"}


def q_asof_domain_counts(spark, d):
    o, c = A.table(spark, d, "orders"), A.table(spark, d, "customer")
    flags = o.join(c, o["o_custkey"] == c["c_custkey"], "inner").select(
        F.col("o_orderdate").alias("submitted"), F.col("c_mktsegment").alias("domain_raw"),
        F.col("o_orderstatus").alias("status"))
    fc = DC.flag_counts(flags, AS_OF, "submitted", "domain_raw", "status",
                        banned="FURNITURE", relabels=SEGMENT_RELABEL,
                        excluded_status=["O", "P"], alias="value")
    bc = DC.bookmark_counts(o, c, AS_OF, "o_orderdate", "o_custkey", "o_orderkey",
                            "c_custkey", "c_mktsegment", banned="FURNITURE",
                            relabels=SEGMENT_RELABEL, alias="value")
    return (fc.withColumn("metric", F.lit("flag_count"))
            .unionByName(bc.withColumn("metric", F.lit("bookmark_count")))
            .select("date", "domain", "metric", "value"))


def q_split_explode_count(spark, d):
    p = A.table(spark, d, "part")
    return DC.list_mention_counts(p, AS_OF, None, "p_name", "p_partkey", separator=" ",
                                  alias="headline_news_count")


# --- sync family --------------------------------------------------------------------

DIM_VALUES = ["ParentCampaignID", "CampaignName", "CampaignDescription", "IsDistributed"]
FACT_KEYS = ["DateTime", "CampaignID", "QueueID"]
FACT_VALUES = ["AHT", "CALLVOLUME"]
FACT_STAGE_NAMES = {"DateTime": "ForecastInterval"}


def q_stage_bounds(spark, d):
    stage, target = A.fact_stage(spark, d), A.fact_target(spark, d)
    outside = rows_outside_stage(target, "DateTime", stage, "ForecastInterval")
    return stage_bounds(stage, "ForecastInterval", "stage_min", "stage_max").select(
        "stage_min", "stage_max",
        outside.select(F.count(F.lit(1))).scalar().alias("target_outside"))


def q_sync_inserts(spark, d):
    return rounded(new_rows(A.fact_stage(spark, d), A.fact_target(spark, d), FACT_KEYS,
                            FACT_STAGE_NAMES, prefilter=True))


def q_sync_dimension(spark, d):
    return sync(A.dim_target(spark, d), A.dim_stage(spark, d), ["CampaignID"], DIM_VALUES,
                "dimension", A.NOW)


def q_sync_fact_always(spark, d):
    return rounded(sync(A.fact_target(spark, d), A.fact_stage(spark, d), FACT_KEYS, FACT_VALUES,
                        "fact", A.NOW, stage_names=FACT_STAGE_NAMES, removed=None))


def q_sync_fact_on_change(spark, d):
    return rounded(sync(A.fact_target(spark, d), A.fact_stage(spark, d), FACT_KEYS, FACT_VALUES,
                        "fact_on_change", A.NOW, stage_names=FACT_STAGE_NAMES, removed=None))


def q_sync_dimension_prefiltered(spark, d):
    return sync(A.dim_target(spark, d), A.dim_stage(spark, d), ["CampaignID"], DIM_VALUES,
                "dimension", A.NOW, prefilter=True)


def q_sync_write_back(spark, d):
    # Target written to a path, synchronised in place (staged overwrite), read back.
    path = scratch_path(spark, "fact_target")
    write_table(A.fact_target(spark, d), path)
    back = sync_table(spark, path, A.fact_stage(spark, d), FACT_KEYS, FACT_VALUES,
                      "fact_on_change", A.NOW, kind="parquet", stage_names=FACT_STAGE_NAMES,
                      removed=None)
    return rounded(back)


def _sync_by_day(spark, d, policy, scope):
    # Target stored by day; only the days that change are rewritten, all are read back.
    path, by_day = scratch_path(spark, "fact_days"), {"day": "to_date(DateTime)"}
    target = A.fact_target(spark, d)
    write_partitioned(target, path, by_day)
    sync_partitions(spark, path, A.fact_stage(spark, d), FACT_KEYS, FACT_VALUES, policy, A.NOW,
                    target.schema, by_day, scope=scope, stage_names=FACT_STAGE_NAMES, removed=None)
    return rounded(read_partitioned(spark, path, target.schema, by_day).drop("day"))


def q_sync_partitions(spark, d):
    return _sync_by_day(spark, d, "fact_on_change", "all")


def q_sync_partitions_of_stage(spark, d):
    return _sync_by_day(spark, d, "fact", "stage")


def q_sync_dimension_repeats(spark, d):
    # The stage also holds an older state of every third campaign: the newest counts.
    new = A.dim_stage(spark, d).withColumn("Revision", F.lit(2))
    old = (new.filter(F.col("CampaignID") % 3 == 0).withColumn("Revision", F.lit(1))
           .withColumn("CampaignName", F.lit("superseded")))
    return sync(A.dim_target(spark, d), old.unionByName(new), ["CampaignID"], DIM_VALUES,
                "dimension", A.NOW, stage_order=["Revision"])


def q_except_distinct(spark, d):
    o, c = A.table(spark, d, "orders"), A.table(spark, d, "customer")
    return o.select(F.col("o_custkey").alias("custkey")).subtract(
        c.filter(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("custkey")))


# --- payloads -------------------------------------------------------------------------

def _unpacked(spark, d):
    return unpack_payload(A.log_payloads(spark, d), "LogSchema", "LogFile",
                          keep=["user_id", "block"])


def q_payload_unpack(spark, d):
    long = _unpacked(spark, d)
    return long.select("user_id", "block", "schema", "line_no",
                       F.get(F.col("values"), 0).alias("field_1"),
                       F.get(F.col("values"), 1).alias("field_2"), "n_fields")


def q_payload_by_schema(spark, d):
    return project_schema(_unpacked(spark, d), "event_id, event_type",
                          {"event_id": "bigint"}, keep=["user_id", "block"])


def q_payload_tables(spark, d):
    # A stored log table, unpacked once, one table per schema found, all read back.
    logs, out = scratch_path(spark, "logs"), scratch_path(spark, "by_schema")
    write_table(A.log_payloads(spark, d).withColumnRenamed("user_id", "owner"), logs)
    ints = {"event_id": "bigint"}
    tables = route_log_table(spark, logs, out, keep=["owner", "block"],
                             types={s: ints for s in ("event_id, event_type", "event_id, user_id")})
    frames = []
    for schema in sorted(tables):
        part = read_schema_table(spark, out, schema).toDF("user_id", "block", "event_id", "field_2")
        frames.append(part.select("user_id", "block", F.lit(schema).alias("schema"), "event_id", "field_2"))
    return reduce(DataFrame.unionByName, frames)


# --- catalog tables and the whole outlook job -------------------------------------------

def _drop_tables(spark, names):
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def q_catalog_tables(spark, d):
    # Saved as catalog tables, read by name, one of them by its two-level name; the
    # result is stored, and the tables are dropped again.
    tag = uuid.uuid4().hex[:12]
    orders, customers, out = f"shiftwise_orders_{tag}", f"default.shiftwise_customers_{tag}", scratch_path(spark, "joined")
    try:
        write_table(A.table(spark, d, "orders"), orders)
        write_table(A.table(spark, d, "customer"), customers, source_system="crm")
        o = read_source(spark, "table", orders, columns=["o_orderkey", "o_custkey", "o_totalprice"])
        c = read_source(spark, "table", customers, columns=["c_custkey", "c_mktsegment", "source_system"])
        joined = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_mktsegment", "o_totalprice",
                                                                    "source_system")
        write_table(joined, out)
    finally:
        _drop_tables(spark, [orders, customers])
    return rounded(spark.read.parquet(out))


def q_catalog_self_replace(spark, d):
    # A catalog table that is read and replaced by its own job, then appended to.
    name, out = f"shiftwise_orders_{uuid.uuid4().hex[:12]}", scratch_path(spark, "replaced")
    try:
        write_table(A.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), name, source_system="first")
        current = read_source(spark, "table", name)
        write_table(current.filter("o_orderstatus <> 'P'").drop("source_system"), name, source_system="second",
                    staged=True)
        more = A.table(spark, d, "orders").filter("o_orderstatus = 'P'").select("o_orderkey", "o_orderstatus")
        write_table(more, name, mode="append", source_system="third")
        write_table(read_source(spark, "table", name), out)
    finally:
        _drop_tables(spark, [name])
    return spark.read.parquet(out)


def q_outlook_job(spark, d):
    # The job as it runs: queue map persisted, clustered overwrite, original column names.
    path = scratch_path(spark, "outlook")
    S.run_staffing_outlook(
        path, A.history(spark, d), A.view_map(spark, d), A.fte(spark, d), A.afte(spark, d),
        A.volume(spark, d), A.requirement(spark, d), A.model_required(spark, d),
        A.REPORT_START, A.REPORT_END, A.FILTER_NAMES, now=A.NOW,
        cluster_by=OUTLOOK_CLUSTER_BY, names=OUTLOOK_OUTPUT)
    return rounded(spark.read.parquet(path))


# --- sinks ------------------------------------------------------------------------------

def q_sink_overwrite(spark, d):
    path = scratch_path(spark, "orders")
    orders = A.table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_custkey")
    write_table(orders, path, mode="overwrite", source_system="initial")
    current = spark.read.parquet(path)
    refreshed = current.select("o_orderkey", F.lower("o_orderpriority").alias("o_orderpriority"), "o_custkey")
    # Reads and rewrites the same path: written beside it, then swapped in.
    write_table(refreshed, path, mode="overwrite", source_system="refresh", staged=True)
    return spark.read.parquet(path)


def q_sink_clustered(spark, d):
    path = scratch_path(spark, "facts")
    f = A.fact15(spark, d).select("QueueID", "DateTime", "event_id", "value")
    write_clustered(f, path, ["DateTime", "QueueID"])
    return rounded(spark.read.parquet(path))


def q_sink_interleaved(spark, d):
    path = scratch_path(spark, "facts")
    f = A.fact15(spark, d).select("QueueID", "DateTime", "event_type", "event_id", "value")
    write_interleaved(f, path, ["DateTime", "QueueID", "event_type"])
    return rounded(spark.read.parquet(path))


def q_equal_depth_slices(spark, d):
    # The slices a partitioned read of orders would use, cut on a skewed column, and
    # how many rows each holds.
    o = A.table(spark, d, "orders").select((F.col("o_custkey") * F.col("o_custkey")).alias("k"))
    n = o.count()
    cuts = equal_depth_cuts(o, "k", 8)
    parts = [o.filter(p).agg(F.count(F.lit(1)).alias("rows")) for p in jdbc_cut_predicates("k", cuts)]
    held = reduce(DataFrame.unionByName, parts)
    return held.agg(F.sum("rows").alias("rows"),
                    F.bool_and(F.col("rows") * 8 <= 2 * n).alias("balanced"))


QUERIES: dict[str, Query] = {
    "validity_join": q_validity_join,
    "validity_join_binned": q_validity_join_binned,
    "validity_join_adaptive": q_validity_join_adaptive,
    "validity_join_merge": q_validity_join_merge,
    "half_hour_floor": q_half_hour_floor,
    "range_filter_inclusive": q_range_filter_inclusive,
    "weighted_average": q_weighted_average,
    "ratio_of_sums": q_ratio_of_sums,
    "reaggregate_half_hour": q_reaggregate_half_hour,
    "lookup_join": q_lookup_join,
    "contract_cutoff": q_contract_cutoff,
    "staffing_outlook": q_staffing_outlook,
    "staffing_outlook_zero_fill": q_staffing_outlook_zero_fill,
    "reporting_week": q_reporting_week,
    "run_week": q_run_week,
    "load_stamp": q_load_stamp,
    "valid_domain_filter": q_valid_domain_filter,
    "code_label_map": q_code_label_map,
    "utilisation_base": q_utilisation_base,
    "two_level_counts": q_two_level_counts,
    "activity_rollup": q_activity_rollup,
    "enrich_keys": q_enrich_keys,
    "latest_per_key": q_latest_per_key,
    "backfill_latest": q_backfill_latest,
    "score_asof_day": q_score_asof_day,
    "utilisation_summary": q_utilisation_summary,
    "asof_domain_counts": q_asof_domain_counts,
    "split_explode_count": q_split_explode_count,
    "chain_join": q_chain_join,
    "slot_report": q_slot_report,
    "unpivot_slots": q_unpivot_slots,
    "exclude_windows": q_exclude_windows,
    "stage_bounds": q_stage_bounds,
    "sync_inserts": q_sync_inserts,
    "sync_dimension": q_sync_dimension,
    "sync_fact_always": q_sync_fact_always,
    "sync_fact_on_change": q_sync_fact_on_change,
    "sync_dimension_prefiltered": q_sync_dimension_prefiltered,
    "sync_write_back": q_sync_write_back,
    "sync_partitions": q_sync_partitions,
    "sync_partitions_of_stage": q_sync_partitions_of_stage,
    "except_distinct": q_except_distinct,
    "payload_unpack": q_payload_unpack,
    "payload_by_schema": q_payload_by_schema,
    "payload_tables": q_payload_tables,
    "sync_dimension_repeats": q_sync_dimension_repeats,
    "catalog_tables": q_catalog_tables,
    "catalog_self_replace": q_catalog_self_replace,
    "outlook_job": q_outlook_job,
    "sink_overwrite": q_sink_overwrite,
    "sink_clustered": q_sink_clustered,
    "sink_interleaved": q_sink_interleaved,
    "equal_depth_slices": q_equal_depth_slices,
}
