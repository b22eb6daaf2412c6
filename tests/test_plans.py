"""Composite jobs on small inline inputs."""

import base64
import datetime as dt

from pyspark.sql import functions as F

from conftest import rows, ts
from shiftwise.plans import domain_counts as DC
from shiftwise.plans import staffing as S
from shiftwise.plans.payloads import schema_frames, unpack_log_table
from shiftwise.plans.slots import slot_report
from shiftwise.session import scratch_path
from shiftwise.sources.sinks import write_table


def _outlook_inputs(spark):
    hist = spark.createDataFrame([
        ("Staffing Outlook", "V1", 1, "2025-07-01", "2025-08-01"),
        ("Staffing Outlook", "V1", 2, "2025-07-01", "2025-08-01"),
        ("Other", "V1", 3, "2025-07-01", "2025-08-01"),
    ], "FilterName string, ViewName string, QueueID int, s string, e string").select(
        "FilterName", "ViewName", "QueueID",
        F.col("s").cast("timestamp_ntz").alias("RecordStartDateInclusive"),
        F.col("e").cast("timestamp_ntz").alias("RecordEndDateNonInclusive"))
    vmap = spark.createDataFrame([("V1", "P", "S", "L", "M")],
                                 "ViewName string, Partner string, Site string, "
                                 "LineOfBusiness string, ServiceModel string")

    def facts(data, cols):
        return spark.createDataFrame(data, cols).withColumn(
            "DateTime", F.col("DateTime").cast("timestamp_ntz"))

    fte = facts([(1, "2025-07-14 10:00:00", 2.0), (1, "2025-07-14 10:15:00", 4.0),
                 (2, "2025-07-14 10:15:00", 6.0), (3, "2025-07-14 10:00:00", 100.0),
                 (1, "2025-07-14 11:00:00", None), (1, "2025-07-14 11:00:00", -1.0)],
                "QueueID int, DateTime string, FTE double")
    queue = facts([(1, "2025-07-14 10:30:00", 8.0)], "QueueID int, DateTime string, AFTE double")
    volume = facts([(1, "2025-07-14 10:00:00", 10.0, 100.0), (2, "2025-07-14 10:15:00", 30.0, 200.0),
                    (1, "2025-07-14 12:00:00", 10.0, None)],
                   "QueueID int, DateTime string, CALLVOLUME double, AHT double")
    req = facts([("V1", "2025-07-14 10:00:00", 5.0), ("V1", "2025-07-14 10:00:00", 7.0)],
                "ViewName string, DateTime string, Required double")
    model = facts([(1, "2025-07-14 10:15:00", 3.0), (2, "2025-07-14 10:15:00", 4.0)],
                  "QueueID int, DateTime string, Required double")
    return hist, vmap, fte, queue, volume, req, model


def test_staffing_outlook(spark):
    hist, vmap, fte, queue, volume, req, model = _outlook_inputs(spark)
    out = S.staffing_outlook(hist, vmap, fte, queue, volume, req, model,
                             "2025-07-13", "2025-08-31", ["Staffing Outlook"],
                             now="2025-09-01 00:00:00")
    assert out.columns == S.REPORT_KEYS + S.METRICS + ["DateCreated"]
    got = {(r.DateTime, r.ContractRequired): r for r in out.collect()}
    ten = ts("2025-07-14 10:00:00")
    # duplicate contract rows fan the 10:00 key out into two rows
    a, b = got[(ten, 5.0)], got[(ten, 7.0)]
    for r in (a, b):
        assert r.ForecastRequired == (2.0 + 4.0 + 6.0) / 2.0      # queue 3 filtered out
        assert r.ForecastVolume == 40.0
        assert r.ForecastAHT == (10 * 100.0 + 30 * 200.0) / 40.0
        assert r.ForecastFTE is None and r.ErlangRequired is None
    half = got[(ts("2025-07-14 10:30:00"), None)]
    assert half.ForecastFTE == 4.0
    # the model-required stage keeps raw quarter-hour stamps
    er = got[(ts("2025-07-14 10:15:00"), None)]
    assert er.ErlangRequired == 7.0 and er.ForecastRequired is None
    noon = got[(ts("2025-07-14 12:00:00"), None)]
    assert noon.ForecastVolume == 10.0 and noon.ForecastAHT is None
    assert out.count() == 5
    assert {r.DateCreated for r in out.collect()} == {dt.datetime(2025, 9, 1)}


def test_staffing_outlook_strategies_and_zero_fill(spark):
    hist, vmap, fte, queue, volume, req, model = _outlook_inputs(spark)
    args = (hist, vmap, fte, queue, volume, req, model, "2025-07-13", "2025-08-31",
            ["Staffing Outlook"])
    base = rows(S.staffing_outlook(*args, now="2025-09-01"))
    for strategy in ("broadcast", "binned", "shuffle", "adaptive", "merge"):
        assert rows(S.staffing_outlook(*args, now="2025-09-01", strategy=strategy)) == base
    filled = S.staffing_outlook(*args, now="2025-09-01", zero_fill=True)
    assert all(r[m] is not None for r in filled.collect() for m in S.METRICS)
    # contradictory cutoff: contract stage empty, no error
    cut = S.staffing_outlook(*args, now="2025-09-01", cutoff="2025-01-12")
    assert all(r.ContractRequired is None for r in cut.collect())


def test_domain_counts(spark):
    flags = spark.createDataFrame([
        ("2025-06-01", "SO Admin", "Draft"), ("2025-06-01", "SO Admin", None),
        ("2025-06-30", "Sales", "Published"), ("2025-07-01", "Sales", "Published"),
        ("2025-06-01", "Testing Admin Only", "Published"), ("2025-06-01", "a,b", "x"),
        ("2025-06-01", "", "x")], "d string, dom string, st string")
    out = DC.flag_counts(flags, "2025-06-30", "d", "dom", "st", banned="Testing Admin Only",
                         relabels={"SO Admin": "SO Operating Enablement"})
    assert rows(out, "domain", "flag_count") == [("SO Operating Enablement", 1), ("Sales", 1)]
    assert dict(out.dtypes)["date"] == "date"

    news = spark.createDataFrame([(1, "2025-06-01", "a;;b;"), (2, "2025-06-02", "a"),
                                  (3, "2025-07-02", "a"), (4, "2025-06-02", None)],
                                 "id int, created string, viewable string")
    out = DC.list_mention_counts(news, "2025-06-30", "created", "viewable", "id", ";",
                                 alias="headline_news_count")
    assert rows(out, "domain", "headline_news_count") == [("", 1), ("a", 2), ("b", 1)]

    bm = spark.createDataFrame([(1, "v1", "2025-06-01"), (2, "v1", "2025-06-01"),
                                (2, "v1", "2025-06-02"), (3, "v2", "2025-06-01"),
                                (4, "v9", "2025-06-01")], "ID int, KA string, CREATED string")
    ver = spark.createDataFrame([("v1", "SO Admin"), ("v2", "Testing Admin Only")],
                                "VID string, DOM string")
    out = DC.bookmark_counts(bm, ver, "2025-06-30", "CREATED", "KA", "ID", "VID", "DOM",
                             banned="Testing Admin Only",
                             relabels={"SO Admin": "SO Operating Enablement"})
    assert rows(out, "domain", "bookmark_count") == [("SO Operating Enablement", 2)]


def test_slot_report(spark):
    n = 4
    campaigns = spark.createDataFrame([(1, "C1")], "ID int, NAME string")
    plans = spark.createDataFrame([(10, 1)], "ID int, CAMPAIGNID int")
    instances = spark.createDataFrame([(100, 10, 1), (101, 10, 0)], "ID int, SPID int, ISBASE int")
    queues = spark.createDataFrame([(7, "Q7")], "ID int, NAME string")
    cols = ", ".join([f"AHT{i} double" for i in range(1, n + 1)] +
                     [f"CALLVOLUME{i} double" for i in range(1, n + 1)])
    series = spark.createDataFrame([
        (100, 7, "2023-03-08 00:00:00", 1.0, 2.0, 3.0, 4.0, 5.0, None, 0.0, -1.0),
        (101, 7, "2023-03-08 00:00:00", 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0),   # not base
        (100, 7, "2023-03-13 04:00:00", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),   # excluded window
        (100, 7, "2023-05-01 00:00:00", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),   # out of range
    ], f"FORECASTINSTANCEID int, SQUEUEID int, DATETIME string, {cols}").withColumn(
        "DATETIME", F.col("DATETIME").cast("timestamp_ntz"))
    out = slot_report(campaigns, plans, instances, series, queues, "2023-03-08", "2023-04-07",
                      n_slots=n, windows=[("2023-03-13 04:00:00", "2023-03-13 04:45:00")])
    assert rows(out, "CampaignName", "QueueName", "slot", "AHT", "CallVolume") == [
        ("C1", "Q7", 1, 1.0, 5.0), ("C1", "Q7", 3, 3.0, 0.0)]


def test_payload_job_roundtrip(spark):
    text = "id,kind\n1, a\n2,b\n"
    other = "x\n"
    df = spark.createDataFrame(
        [(1, "id, kind", "string,string", base64.b64encode(text.encode()).decode()),
         (2, "x", "string", base64.b64encode(other.encode()).decode())],
        "log_id int, LogSchema string, LogSchemaTypes string, LogFile string")
    path = scratch_path(spark, "logs")
    write_table(df, path)
    long = unpack_log_table(spark, path, keep=["log_id"])
    frames = schema_frames(long, {"id, kind": {"id": "int"}, "x": None}, keep=["log_id"])
    assert rows(frames["id, kind"]) == [(1, 1, "a"), (1, 2, "b")]
    assert rows(frames["x"]) == []           # header-only payload: no data lines


def test_run_staffing_outlook_writes_clustered(spark):
    inputs = _outlook_inputs(spark)
    path = scratch_path(spark, "outlook")
    before = set(spark.sparkContext._jsc.getPersistentRDDs())
    S.run_staffing_outlook(path, *inputs, "2025-07-13", "2025-08-31", ["Staffing Outlook"],
                           now="2025-09-01 00:00:00")
    back = spark.read.parquet(path)
    expected = S.staffing_outlook(*inputs, "2025-07-13", "2025-08-31", ["Staffing Outlook"],
                                  now="2025-09-01 00:00:00")
    assert rows(back) == rows(expected)
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) == before   # map released


def test_outlook_keys_unique_when_contract_unique(spark):
    hist, vmap, fte, queue, volume, req, model = _outlook_inputs(spark)
    req = req.dropDuplicates(["ViewName", "DateTime"])     # one contract row per key
    out = S.staffing_outlook(hist, vmap, fte, queue, volume, req, model,
                             "2025-07-13", "2025-08-31", ["Staffing Outlook"], now="2025-09-01")
    assert out.count() == out.select(*S.REPORT_KEYS).distinct().count() == 4


def test_output_schemas(spark):
    from pyspark.sql.types import _parse_datatype_string
    from shiftwise.plans import utilisation as U
    from test_presets import _utilisation_tables
    from shiftwise.plans import presets as P

    hist, vmap, fte, queue, volume, req, model = _outlook_inputs(spark)
    out = S.staffing_outlook(hist, vmap, fte, queue, volume, req, model,
                             "2025-07-13", "2025-08-31", ["Staffing Outlook"], now="2025-09-01")
    assert out.schema.simpleString() == _parse_datatype_string(S.OUTPUT_DDL).simpleString()
    util = P.utilisation_from_tables(*_utilisation_tables(spark), run_date="2024-01-10")
    # the quality score keeps its source column's type; everything else is fixed
    assert util.drop("acrolinx_score").schema.simpleString() == \
        _parse_datatype_string(U.OUTPUT_DDL).simpleString()


def test_link_activity_keeps_empty_domain(spark):
    import datetime as dt
    from shiftwise.plans import utilisation as U
    p = U.UtilisationParams(base_sources=[], view_sources=[], record_types={}, governance=[])
    arts = spark.createDataFrame([(1, "", "A1", "T", "R", "G", None, None, None, None, None),
                                  (2, None, "A2", "T", "R", "G", None, None, None, None, None)],
                                 "id int, domain string, article_number string, title string, "
                                 "record_type_id string, governance string, created_date timestamp, "
                                 "product_line string, shared_with string, "
                                 "validation_status string, last_modified_date timestamp")
    links = spark.createDataFrame([(1, dt.datetime(2024, 1, 2), "Use"),
                                   (2, dt.datetime(2024, 1, 2), "Use")],
                                  "article_id int, link_date timestamp, link_type string")
    out = U.link_activity(arts, links, p, F.lit("2024-01-01").cast("date"),
                          F.lit("2024-01-31").cast("date"))
    assert rows(out, "domain", "article_number", "Use_Counts") == [("", "A1", 1)]
