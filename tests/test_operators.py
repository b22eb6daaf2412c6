"""DataFrame operators on inline fixtures."""

import base64

import pytest
from pyspark.sql import functions as F

from conftest import rows, ts
from shiftwise.operators import (
    backfill,
    enrich,
    exclude_windows,
    explode_list,
    full_outer_chain,
    latest_per_key,
    new_rows,
    project_schema,
    reaggregate_half_hour,
    rows_outside_stage,
    stage_bounds,
    two_level_count,
    union_canonical,
    unpack_payload,
    unpivot_slots,
    validity_join,
)
from shiftwise.operators.reshape import slot_columns

VERSIONS = [
    # queue 1: two overlapping versions; queue 2: one version; queue 3: none;
    # queue 4: NULL end (never matches)
    (1, "A", "2024-01-01 00:00:00", "2024-01-10 00:00:00"),
    (1, "B", "2024-01-05 00:00:00", "2024-01-20 00:00:00"),
    (2, "C", "2024-01-02 00:00:00", "2024-01-03 00:00:00"),
    (4, "D", "2024-01-01 00:00:00", None),
]
FACTS = [
    (1, "2024-01-01 00:00:00", 1.0),   # exactly at start of A
    (1, "2024-01-10 00:00:00", 2.0),   # exactly at end of A (excluded), inside B
    (1, "2024-01-06 12:00:00", 3.0),   # inside both A and B
    (1, "2023-12-31 23:59:59", 4.0),   # one before A
    (2, "2024-01-02 23:59:59", 5.0),   # inside C, last second
    (2, "2024-01-03 00:00:00", 6.0),   # end of C
    (3, "2024-01-05 00:00:00", 7.0),   # queue without versions
    (4, "2024-01-05 00:00:00", 8.0),   # NULL end
]


def _validity_frames(spark):
    v = spark.createDataFrame(VERSIONS, "QueueID int, View string, s string, e string").select(
        "QueueID", "View", F.col("s").cast("timestamp_ntz").alias("Start"),
        F.col("e").cast("timestamp_ntz").alias("End"))
    f = spark.createDataFrame(FACTS, "QueueID int, t string, v double").select(
        "QueueID", F.col("t").cast("timestamp_ntz").alias("DateTime"), "v")
    return f, v


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle", "binned", "adaptive", "merge", "auto"])
def test_validity_join_edges(spark, strategy):
    f, v = _validity_frames(spark)
    out = validity_join(f, v, ["QueueID"], "DateTime", "Start", "End", strategy=strategy)
    assert out.columns == ["QueueID", "DateTime", "v", "View", "Start", "End"]
    assert rows(out, "v", "View") == [(1.0, "A"), (2.0, "B"), (3.0, "A"), (3.0, "B"), (5.0, "C")]


def test_validity_join_binned_equals_broadcast_with_wide_bins_and_clip(spark):
    f, v = _validity_frames(spark)
    base = rows(validity_join(f, v, ["QueueID"], "DateTime", "Start", "End", strategy="broadcast"))
    for bin_days in (1, 3, 30):
        b = validity_join(f, v, ["QueueID"], "DateTime", "Start", "End", strategy="binned",
                          bin_days=bin_days)
        assert rows(b) == base
    clipped = validity_join(f, v, ["QueueID"], "DateTime", "Start", "End", strategy="binned",
                            clip=("2024-01-02", "2024-01-08"))
    assert rows(clipped, "v", "View") == [(3.0, "A"), (3.0, "B"), (5.0, "C")]


def test_validity_join_rejects_clashing_columns(spark):
    f, v = _validity_frames(spark)
    with pytest.raises(ValueError):
        validity_join(f.withColumn("View", F.lit("x")), v, ["QueueID"], "DateTime", "Start", "End")


def _chain_frames(spark):
    a = spark.createDataFrame([("k1", "x", 1.0), ("k2", "x", 2.0), (None, "x", 3.0)],
                              "k string, j string, m1 double")
    b = spark.createDataFrame([("k1", "x", 10.0), ("k3", "x", 30.0), (None, "x", 40.0)],
                              "k string, j string, m2 double")
    c = spark.createDataFrame([("k1", "x", 100.0), ("k1", "x", 101.0), ("k4", "x", 400.0)],
                              "k string, j string, m3 double")   # duplicate key on purpose
    d = spark.createDataFrame([("k2", "x", 1000.0)], "k string, j string, m4 double")
    return a, b, c, d


def _reference_chain(frames, keys):
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, keys, "full_outer")
    return out


def test_full_outer_chain_semantics(spark):
    a, b, c, d = _chain_frames(spark)
    keys = ["k", "j"]
    expected = rows(_reference_chain([a, b, c, d], keys), "k", "j", "m1", "m2", "m3", "m4")
    got = full_outer_chain([a, b, c, d], keys)
    assert rows(got, "k", "j", "m1", "m2", "m3", "m4") == expected
    # NULL keys never match: both NULL-key rows survive separately
    assert sum(1 for r in expected if r[0] is None) == 2
    # duplicate key in c fans out
    assert sum(1 for r in expected if r[0] == "k1") == 2
    fast = full_outer_chain([a, b, c, d], keys, unique=[True, True, False, True])
    assert rows(fast, "k", "j", "m1", "m2", "m3", "m4") == expected


def test_full_outer_chain_zero_fill(spark):
    a, b, _, d = _chain_frames(spark)
    got = full_outer_chain([a, b, d], ["k", "j"], zero_fill=True, unique=True)
    vals = rows(got, "k", "m1", "m2", "m4")
    assert ("k3", 0.0, 30.0, 0.0) in vals
    assert all(v is not None for r in vals for v in r[1:])


def test_enrich_inner_and_left(spark):
    base = spark.createDataFrame([("d1", "a", 1), ("d2", "b", 2), ("d3", None, 3)],
                                 "date string, dom string, x int")
    facts = spark.createDataFrame([("d1", "a", 10), ("d3", None, 30)],
                                  "link_date string, dom string, cnt int")
    inner = enrich(base, facts, ["date", "dom"], "inner", columns=["cnt", "link_date"],
                   fact_keys=["link_date", "dom"])
    assert rows(inner, "date", "cnt", "link_date") == [("d1", 10, "d1")]   # NULL key dropped
    left = enrich(base, facts, ["date", "dom"], "left", columns=["cnt"],
                  fact_keys=["link_date", "dom"])
    assert rows(left, "date", "cnt") == [("d1", 10), ("d2", None), ("d3", None)]


def test_backfill_replaces_columns_in_place(spark):
    base = spark.createDataFrame([("1", None, "keep"), ("2", "own", None), ("3", None, None)],
                                 "id string, a string, b string")
    latest = spark.createDataFrame([("1", "L1", "X"), ("2", "L2", "Y")],
                                   "id string, a string, bb string")
    out = backfill(base, latest, ["id"], {"a": "a", "b": "bb"})
    assert out.columns == base.columns
    assert rows(out) == [("1", "L1", "keep"), ("2", "own", "Y")]


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-02", 1), ("a", "2024-01-02", 2), ("a", "2024-01-01", 3),
         ("b", None, 4), ("b", "2023-01-01", 5), ("c", None, 6)],
        "k string, d string, tie int")
    out = latest_per_key(df, ["k"], [F.col("d").cast("date")], tie_break=["tie"])
    assert rows(out, "k", "tie") == [("a", 2), ("b", 5), ("c", 6)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_two_level_count_counts_ids_per_source(spark):
    s1 = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", 3)], "k string, id int")
    s2 = spark.createDataFrame([("x", 1), ("z", 9)], "k string, id int")
    out = two_level_count([s1, s2], ["k"], "id", "n")
    assert rows(out) == [("x", 3), ("y", 1), ("z", 1)]   # id 1 counted once per source
    assert dict(out.dtypes)["n"] == "bigint"


def test_union_canonical(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1), ("x", 1)], "s string, n bigint")
    out = union_canonical([a, b], ["n", "s"], types={"n": "string"}, distinct=True)
    assert out.dtypes == [("n", "string"), ("s", "string")]
    assert rows(out) == [("1", "x")]


def test_explode_list_pieces(spark):
    df = spark.createDataFrame([(1, "a;;b;"), (2, None), (3, " a"), (4, "x.y")],
                               "id int, l string")
    out = rows(explode_list(df, "l", ";", "d"), "id", "d")
    assert out == [(1, ""), (1, ""), (1, "a"), (1, "b"), (3, " a"), (4, "x.y")]
    # regex metacharacters are literal by default
    assert rows(explode_list(df.filter("id = 4"), "l", ".", "d"), "d") == [("x",), ("y",)]


def test_unpivot_slots_pairs_by_position(spark):
    df = spark.createDataFrame(
        [(7, "2024-01-01 00:00:00", 10.0, 20.0, 30.0, 40.0, 1.0, None, 0.0, -2.0)],
        "q int, base string, AHT1 double, AHT2 double, AHT3 double, AHT4 double, "
        "CV1 double, CV2 double, CV3 double, CV4 double").withColumn(
        "base", F.col("base").cast("timestamp_ntz"))
    out = unpivot_slots(df, ["q"], {"AHT": slot_columns("AHT", 4), "CallVolume": slot_columns("CV", 4)},
                        base_ts="base")
    assert out.count() == 4
    got = rows(out, "slot", "slot_ts", "AHT", "CallVolume")
    assert got[0] == (1, ts("2024-01-01 00:00:00"), 10.0, 1.0)
    assert got[3] == (4, ts("2024-01-01 00:45:00"), 40.0, -2.0)
    kept = out.filter(F.col("CallVolume") >= 0)
    assert rows(kept, "slot") == [(1,), (3,)]   # NULL and negative volume dropped


def _b64(s: bytes) -> str:
    return base64.b64encode(s).decode()


def test_unpack_payload(spark):
    data = [
        (1, "a, b", _b64(b"a,b\n1, x\n2,y\n")),          # header present (spaces ignored)
        (2, "a,b", _b64(b"1,x\n2,y")),                     # no header
        (3, "a,b", _b64(b"a,b\r\n1,x\r\n2,y,extra\r\n")),  # CRLF: header kept as data; ragged line
    ]
    df = spark.createDataFrame(data, "id int, LogSchema string, LogFile string")
    out = unpack_payload(df, "LogSchema", "LogFile", keep=["id"])
    got = rows(out, "id", "line_no", "values", "ragged")
    assert (1, 1, ["1", "x"], False) in got and (1, 2, ["2", "y"], False) in got
    assert not any(r[0] == 1 and r[1] == 0 for r in got)
    assert (2, 0, ["1", "x"], False) in got
    assert (3, 0, ["a", "b"], False) in got            # "a,b\r" != schema: kept, like the original
    assert (3, 2, ["2", "y", "extra"], True) in got
    typed = project_schema(out, "a, b", {"a": "int"}, keep=["id"])
    assert typed.dtypes == [("id", "int"), ("a", "int"), ("b", "string")]
    assert (3, None, "b") in rows(typed)                # bad int -> NULL, no error


def test_unpack_payload_bad_input(spark):
    df = spark.createDataFrame([(1, "a", _b64(b"\xff\xfe\xfa")), (2, "a", "!!!notbase64"),
                                (3, "a", _b64(b"v\n"))], "id int, s string, p string")
    for bad in (1, 2):  # as the original parser: malformed input fails the job
        with pytest.raises(Exception):
            unpack_payload(df.filter(F.col("id") == bad), "s", "p").collect()
    out = unpack_payload(df, "s", "p", keep=["id"], on_error="null")
    got = rows(out, "id", "line_no", "values", "decode_error")
    assert got == [(1, None, None, True), (2, None, None, True), (3, 0, ["v"], False)]


def test_exclude_windows(spark):
    df = spark.createDataFrame([("2022-11-06 02:00:00",), ("2022-11-06 02:45:00",),
                                ("2022-11-06 02:46:00",), (None,)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t"))
    out = exclude_windows(df, "t", [("2022-11-06 02:00:00", "2022-11-06 02:45:00")])
    assert rows(out) == [(ts("2022-11-06 02:46:00"),)]


def test_stage_bounds_and_outside(spark):
    stage = spark.createDataFrame([(5,), (9,)], "t int")
    target = spark.createDataFrame([(4,), (5,), (9,), (10,)], "t int")
    assert tuple(stage_bounds(stage, "t").first()) == (5, 9)
    assert rows(rows_outside_stage(target, "t", stage, "t")) == [(4,), (10,)]
    empty = stage.filter("t < 0")
    assert tuple(stage_bounds(empty, "t").first()) == (None, None)


def test_new_rows_is_left_anti(spark):
    stage = spark.createDataFrame([(1, "a"), (2, "b")], "FI int, v string")
    target = spark.createDataFrame([(1,)], "DT int")
    out = new_rows(stage, target, ["DT"], {"DT": "FI"})
    assert rows(out) == [(2, "b")]
    assert "LeftAnti" in out._jdf.queryExecution().executedPlan().toString()


def test_reaggregate_half_hour(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00", 1.0), ("2024-01-01 10:00:00", 2.0),
                                ("2024-01-01 10:15:00", 4.0), ("2024-01-01 10:30:00", 8.0)],
                               "s string, v double").select(
        F.col("s").cast("timestamp_ntz").alias("t"), F.lit("x").alias("k"), "v")
    out = reaggregate_half_hour(df, "t", ["k"], "v", "fte")
    assert rows(out, "DateTime", "fte") == [(ts("2024-01-01 10:00:00"), 3.5),
                                            (ts("2024-01-01 10:30:00"), 4.0)]


def test_duplicate_keys(spark):
    from shiftwise.operators import duplicate_keys
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c")],
                               "k int, v string")
    assert rows(duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]


def test_operators_refuse_empty_keys(spark):
    from shiftwise.operators import sync
    f, v = _validity_frames(spark)
    for call in (lambda: validity_join(f, v, [], "DateTime", "Start", "End"),
                 lambda: enrich(f, v, []),
                 lambda: full_outer_chain([f, v], []),
                 lambda: backfill(f, v, [], ["v"]),
                 lambda: sync(f, v, [], ["v"], "fact", "2025-01-01")):
        with pytest.raises(ValueError):
            call()


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle", "binned", "adaptive", "merge", "auto_small", "auto_large"])
def test_validity_join_clips_in_every_strategy(spark, strategy):
    facts = spark.createDataFrame([(1, ts("2024-01-05")), (1, ts("2024-03-05"))],
                                  "k int, at timestamp_ntz")
    versions = spark.createDataFrame([(1, "v", ts("2024-01-01"), ts("2025-01-01")),
                                      (1, "w", ts("2024-02-01"), ts("2025-01-01"))],
                                     "k int, name string, s timestamp_ntz, e timestamp_ntz")
    option = {"auto_small": {"broadcast_max_bytes": 2**63}, "auto_large": {"broadcast_max_bytes": 0}}.get(strategy, {})
    got = validity_join(facts, versions, ["k"], "at", "s", "e", strategy=strategy.split("_")[0],
                        clip=("2024-01-01", "2024-01-31"), **option)
    assert rows(got, "at", "name") == [(ts("2024-01-05"), "v")]


def test_full_outer_chain_checks_its_unique_frames(spark):
    u = spark.createDataFrame([("a", 1), ("a", 2)], "k string, x int")
    v = spark.createDataFrame([("a", 3)], "k string, y int")
    with pytest.raises(Exception, match="repeated key"):
        full_outer_chain([u, v], ["k"], unique=True).collect()


def test_full_outer_chain_keeps_copies_and_null_keys(spark):
    n = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 5), (None, 5)], "k string, x int")
    u = spark.createDataFrame([("a", 7), ("b", 8), (None, 9)], "k string, y int")
    got = full_outer_chain([u, n], ["k"], unique=[True, False])
    assert rows(got, "k", "y", "x") == rows(u.join(n, ["k"], "full_outer"), "k", "y", "x")


def test_unpack_payload_null_payload(spark):
    df = spark.createDataFrame([("a,b", None)], "LogSchema string, LogFile string")
    with pytest.raises(Exception, match="NULL payload"):
        unpack_payload(df, "LogSchema", "LogFile").collect()
    (r,) = unpack_payload(df, "LogSchema", "LogFile", on_error="null").collect()
    assert r["decode_error"] and r["values"] is None
