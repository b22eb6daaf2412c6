"""The reference jobs' input tables, derived from the driver's test tables.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns follow the input contract of a job in ``shiftwise.plans``. The same
derivations are written in SQL in ``shiftwise.plans.oracle`` (keep the two in
step). Every builder reads whole tables; filters below only *define* an
analog (e.g. which events play the role of FTE facts), never sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.functions.temporal import floor_minutes

# Fixed values of the analog definitions (mirrored in oracle.py).
REPORT_START = "2024-01-03"
REPORT_END = "2024-01-28"
FILTER_NAMES = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
NOW = "2025-01-01 00:00:00"
VERSION_EPOCH = "2024-01-01"
RECORD_TYPES = {"RT0": "Alert", "RT1": "Issue", "RT2": "Question", "RT3": "Reference"}
GOVERNANCE = ["Brand#1", "Brand#2", "Brand#3", "Brand#5", "Brand#8", "Brand#13",
              "Brand#21"]
BANNED_DOMAIN = "PROMO"
WINDOW = ("1995-01-01", "2001-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, read afresh."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ntz(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def _days(n) -> Column:
    return F.make_dt_interval(n.cast("int") if isinstance(n, Column) else F.lit(int(n)))


# --- events as quarter-hour forecast facts -----------------------------------

def fact15(spark, d) -> DataFrame:
    """events: QueueID = user_id, DateTime = ts floored to 15 minutes."""
    e = table(spark, d, "events")
    return e.select("event_id", F.col("user_id").alias("QueueID"),
                    floor_minutes("ts", 15).alias("DateTime"), "ts", "event_type", "value",
                    (F.col("event_id") % 600 + 60).cast("double").alias("aht"))


def history(spark, d) -> DataFrame:
    """customer as validity-versioned queue filters. Every queue has a 15-day
    version; one in three goes straight on with an adjacent version in another
    view, one in seven has an overlapping version in a third."""
    def version(days: int, view: int):
        return F.struct(F.lit(days).alias("days"), F.lit(view).alias("view"))

    k = F.col("c_custkey")
    c = table(spark, d, "customer").withColumn("v", F.explode(F.array_compact(F.array(
        version(0, 0), F.when(k % 3 == 0, version(15, 3)), F.when(k % 7 == 0, version(5, 1))))))
    start = _ntz(VERSION_EPOCH) + _days(k % 10 + F.col("v.days"))
    return c.select(F.col("c_mktsegment").alias("FilterName"),
                    F.concat(F.lit("VIEW_"), ((F.col("c_nationkey") + F.col("v.view")) % 25)
                             .cast("string")).alias("ViewName"),
                    k.alias("QueueID"),
                    start.alias("RecordStartDateInclusive"),
                    (start + _days(15)).alias("RecordEndDateNonInclusive"))


def view_map(spark, d) -> DataFrame:
    """nation x region as the view -> partner / site / line / model lookup; one
    view in five has a second row (another site), so its rows fan out."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner").withColumn("site", F.explode(
        F.array_compact(F.array(F.col("n_name"), F.when(
            F.col("n_nationkey") % 5 == 0, F.concat("n_name", F.lit(" II")))))))
    return j.select(
        F.concat(F.lit("VIEW_"), F.col("n_nationkey").cast("string")).alias("ViewName"),
        F.col("r_name").alias("Partner"), F.col("site").alias("Site"),
        F.concat(F.lit("LOB_"), (F.col("n_nationkey") % 4).cast("string")).alias("LineOfBusiness"),
        F.when(F.col("n_regionkey") % 2 == 0, F.lit("VOICE")).otherwise(F.lit("CHAT"))
        .alias("ServiceModel"))


def _facts_of(spark, d, event_type: str) -> DataFrame:
    return fact15(spark, d).filter(F.col("event_type") == event_type)


def fte(spark, d):
    return _facts_of(spark, d, "view").select("QueueID", "DateTime", F.col("value").alias("FTE"))


def afte(spark, d):
    return _facts_of(spark, d, "click").select("QueueID", "DateTime", F.col("value").alias("AFTE"))


def volume(spark, d):
    return _facts_of(spark, d, "purchase").select(
        "QueueID", "DateTime", F.col("value").alias("CALLVOLUME"), F.col("aht").alias("AHT"))


def requirement(spark, d):
    return _facts_of(spark, d, "signup").select(
        F.concat(F.lit("VIEW_"), (F.col("QueueID") % 25).cast("string")).alias("ViewName"),
        "DateTime", F.col("value").alias("Required"))


def model_required(spark, d):
    return _facts_of(spark, d, "error").select("QueueID", "DateTime",
                                               F.col("value").alias("Required"))


def contract_orders(spark, d):
    """orders as a contract requirement per view."""
    o = table(spark, d, "orders")
    return o.select(
        F.concat(F.lit("VIEW_"), (F.col("o_custkey") % 25).cast("string")).alias("ViewName"),
        F.col("o_orderdate").alias("DateTime"), F.col("o_totalprice").alias("Required"))


# --- knowledge articles: part as articles, lineitem as links / clicks / flags --

def _record_type_code() -> Column:
    return F.concat(F.lit("RT"), (F.col("p_size") % 5).cast("string"))


def _record_type_label() -> Column:
    from shiftwise.functions.labels import label_map
    return label_map(_record_type_code(), RECORD_TYPES)


def articles(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    created = _ntz("1994-01-01") + _days(F.col("p_partkey") % 365)
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("domain"),
        F.col("p_partkey").alias("article_number"), F.col("p_name").alias("title"),
        _record_type_code().alias("record_type_id"), F.col("p_brand").alias("governance"),
        created.alias("created_date"), F.col("p_type").alias("product_line"),
        F.concat(F.lit("S"), (F.col("p_size") % 3).cast("string")).alias("shared_with"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Validated")).otherwise(F.lit("Pending"))
        .alias("validation_status"),
        (created + _days(F.col("p_size"))).alias("last_modified_date"))


def links(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_partkey").alias("article_id"), F.col("l_shipdate").alias("link_date"),
        F.when(F.col("l_returnflag") == "A", F.lit("Use"))
        .when(F.col("l_returnflag") == "R", F.lit("Reference"))
        .otherwise(F.lit("Other")).alias("link_type"))


def _line_part(spark, d) -> DataFrame:
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    return li.join(p, li["l_partkey"] == p["p_partkey"], "inner")


def _click_cols(source: Column) -> list:
    return [F.col("l_shipdate").alias("datetime"), source.alias("source_name"),
            F.col("p_type").alias("domain"), F.col("l_partkey").alias("article_number"),
            F.col("p_name").alias("document_title"),
            _record_type_label().alias("article_record_type"),
            F.col("p_brand").alias("governance"), F.col("l_orderkey").alias("click_id")]


def clicks(spark, d) -> DataFrame:
    lp = _line_part(spark, d).filter(F.col("l_returnflag") != "N")
    src = F.when(F.col("l_linestatus") == "F", F.lit("ARCHIVE")).otherwise(F.lit("PORTAL"))
    return lp.select(*_click_cols(src))


def clicks_alt(spark, d) -> DataFrame:
    lp = _line_part(spark, d).filter(F.col("l_returnflag") == "N")
    src = F.when(F.col("l_linenumber") % 2 == 0, F.lit("PORTAL")).otherwise(F.lit("MOBILE"))
    return lp.select(*_click_cols(src))


def flags(spark, d) -> DataFrame:
    lp = _line_part(spark, d)
    status = (F.when(F.col("l_returnflag") == "R", F.lit("Withdrawn"))
              .when(F.col("l_linestatus") == "O", F.lit("Draft"))
              .otherwise(F.lit("Published")))
    return lp.select(F.col("l_shipdate").alias("submitted_at"), F.col("p_type").alias("domain"),
                     F.col("l_partkey").cast("string").alias("article_number"),
                     F.col("p_name").alias("title"),
                     _record_type_label().alias("record_type"),
                     F.col("p_brand").alias("governance"), status.alias("status"))


def scores(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("article_number"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("scored_at"),
        F.col("l_quantity").alias("score"))


def utilisation_params():
    from shiftwise.plans.utilisation import UtilisationParams
    return UtilisationParams(base_sources=["ARCHIVE", "PORTAL"],
                             view_sources=["ARCHIVE", "MOBILE"],
                             record_types=RECORD_TYPES, governance=GOVERNANCE,
                             banned_domain=BANNED_DOMAIN)


# --- orders / events as sync targets and stages --------------------------------

def dim_target(spark, d) -> DataFrame:
    o = table(spark, d, "orders").filter(F.col("o_orderdate") < "2000-01-01")
    return o.select(
        F.col("o_orderkey").alias("CampaignID"), F.col("o_custkey").alias("ParentCampaignID"),
        F.col("o_orderpriority").alias("CampaignName"),
        F.col("o_orderstatus").alias("CampaignDescription"),
        (F.col("o_totalprice") > 200000).alias("IsDistributed"),
        F.col("o_orderdate").alias("RecordCreatedDateTime"),
        (F.col("o_orderdate") + _days(1)).alias("RecordLastModifiedDateTime"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate") + _days(30))
        .alias("RecordRemovedDateTime"))


def dim_stage(spark, d) -> DataFrame:
    o = table(spark, d, "orders").filter(F.col("o_orderdate") >= "1996-01-01")
    return o.select(
        F.col("o_orderkey").alias("CampaignID"), F.col("o_custkey").alias("ParentCampaignID"),
        F.when(F.col("o_orderstatus") == "O", F.concat(F.col("o_orderpriority"), F.lit("*")))
        .otherwise(F.col("o_orderpriority")).alias("CampaignName"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderstatus")).alias("CampaignDescription"),
        (F.col("o_totalprice") > 200000).alias("IsDistributed"))


def fact_target(spark, d) -> DataFrame:
    f = fact15(spark, d).filter(F.col("ts") < "2024-01-22")
    return f.select(
        "DateTime", F.col("QueueID").alias("CampaignID"), F.col("event_id").alias("QueueID"),
        F.when(F.col("event_type") == "signup", F.lit(None).cast("double"))
        .otherwise(F.col("aht")).alias("AHT"),
        F.col("value").alias("CALLVOLUME"),
        F.to_date("ts").cast("timestamp_ntz").alias("RecordCreatedDateTime"),
        F.col("DateTime").alias("RecordLastModifiedDateTime"))


def fact_stage(spark, d) -> DataFrame:
    f = fact15(spark, d).filter(F.col("ts") >= "2024-01-08")
    return f.select(
        F.col("DateTime").alias("ForecastInterval"), F.col("QueueID").alias("CampaignID"),
        F.col("event_id").alias("QueueID"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
        .otherwise(F.col("aht")).alias("AHT"),
        F.when(F.col("event_type") == "click", F.col("value") * 1.1)
        .when(F.col("event_type") == "view", F.lit(None).cast("double"))
        .otherwise(F.col("value")).alias("CALLVOLUME"))


# --- events as wide 96-slot rows and as base64 log payloads ----------------------

def wide_slots(spark, d, n_slots: int = 96) -> DataFrame:
    """events per (user, day): CALLVOLUMEi = sum of values in quarter-hour i,
    AHTi = max handle time in it (NULL where the slot has no event).

    ``pivot`` with the slot list given: Spark aggregates per (user, day, slot)
    first, then spreads the slots into columns."""
    f = fact15(spark, d).withColumn(
        "__slot", (F.hour("ts") * 4 + F.floor(F.minute("ts") / 15) + 1).cast("int"))
    wide = (f.groupBy(F.col("QueueID"),
                      F.to_date("ts").cast("timestamp_ntz").alias("BaseDateTime"))
            .pivot("__slot", list(range(1, n_slots + 1)))
            .agg(F.max("aht").alias("AHT"), F.sum("value").alias("CALLVOLUME")))
    return wide.select(
        "QueueID", "BaseDateTime",
        *[F.col(f"{i}_AHT").alias(f"AHT{i}") for i in range(1, n_slots + 1)],
        *[F.col(f"{i}_CALLVOLUME").alias(f"CALLVOLUME{i}") for i in range(1, n_slots + 1)])


def slot_tables(spark, d) -> tuple[DataFrame, ...]:
    """Campaign / plan / instance / series / queue tables for the slot report:
    region -> nation -> customer (base instance for two segments) -> wide
    events series (instance = user) -> nation as queue."""
    campaigns = table(spark, d, "region").select(F.col("r_regionkey").alias("ID"),
                                                 F.col("r_name").alias("NAME"))
    plans = table(spark, d, "nation").select(F.col("n_nationkey").alias("ID"),
                                             F.col("n_regionkey").alias("CAMPAIGNID"))
    instances = table(spark, d, "customer").select(
        F.col("c_custkey").alias("ID"), F.col("c_nationkey").alias("SPID"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit(1))
        .otherwise(F.lit(0)).alias("ISBASE"))
    queues = table(spark, d, "nation").select(F.col("n_nationkey").alias("ID"),
                                              F.col("n_name").alias("NAME"))
    wide = wide_slots(spark, d)
    series = wide.select(F.col("QueueID").alias("FORECASTINSTANCEID"),
                         (F.col("QueueID") % 25).cast("int").alias("SQUEUEID"),
                         F.col("BaseDateTime").alias("DATETIME"),
                         *[c for c in wide.columns if c.startswith(("AHT", "CALLVOLUME"))])
    return campaigns, plans, instances, series, queues


LOG_BLOCK = 1000  # events per payload block: bounds every payload's size


def log_payloads(spark, d) -> DataFrame:
    """events packed into base64 CSV payloads, one per (user, block of 1000
    event ids) - each payload is bounded by the block size. Even users log
    ``event_id, event_type``; odd users ``event_id, user_id``; users whose id
    is a multiple of 3 have no header line."""
    e = table(spark, d, "events")
    even = F.col("user_id") % 2 == 0
    line = F.when(even, F.concat(F.col("event_id").cast("string"), F.lit(", "), F.col("event_type"))) \
        .otherwise(F.concat(F.col("event_id").cast("string"), F.lit(","), F.col("user_id").cast("string")))
    rows = e.select("user_id", (F.col("event_id") / LOG_BLOCK).cast("bigint").alias("block"),
                    "event_id", line.alias("__line"))
    grouped = rows.groupBy("user_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("event_id", "__line"))).alias("__ls"))
    schema = F.when(F.col("user_id") % 2 == 0, F.lit("event_id, event_type")) \
        .otherwise(F.lit("event_id, user_id"))
    body = F.array_join(F.transform("__ls", lambda s: s["__line"]), "\n")
    header = F.when(F.col("user_id") % 3 == 0, F.lit("")) \
        .otherwise(F.concat(F.replace(schema, F.lit(" "), F.lit("")), F.lit("\n")))
    text = F.concat(header, body, F.lit("\n"))
    return grouped.select("user_id", "block", schema.alias("LogSchema"),
                          F.lit("string,string").alias("LogSchemaTypes"),
                          F.base64(F.encode(text, "UTF-8")).alias("LogFile"))
