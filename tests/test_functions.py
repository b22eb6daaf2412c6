"""Column builders on hand-written rows (NULLs, ties, edges the driver tables lack)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows, ts
from shiftwise.functions import (
    changed,
    count_unless,
    count_where,
    floor_minutes,
    half_hour_floor,
    in_range,
    label_map,
    nullness_changed,
    positive,
    ratio_of_sums,
    relabel,
    reporting_week,
    valid_label,
    weighted_average,
    within_interval,
)


def test_half_hour_floor_minutes(spark):
    stamps = ["2024-01-01 10:00:00", "2024-01-01 10:07:00", "2024-01-01 10:15:00",
              "2024-01-01 10:30:00", "2024-01-01 10:45:00", "2024-01-01 10:59:00",
              "2024-01-01 10:15:30"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t"))
    out = dict(rows(df.select("t", half_hour_floor("t").alias("h"))))
    assert out[ts("2024-01-01 10:00:00")] == ts("2024-01-01 10:00:00")
    assert out[ts("2024-01-01 10:07:00")] == ts("2024-01-01 10:07:00")   # not on a quarter
    assert out[ts("2024-01-01 10:15:00")] == ts("2024-01-01 10:00:00")
    assert out[ts("2024-01-01 10:30:00")] == ts("2024-01-01 10:30:00")
    assert out[ts("2024-01-01 10:45:00")] == ts("2024-01-01 10:30:00")
    assert out[ts("2024-01-01 10:59:00")] == ts("2024-01-01 10:59:00")
    assert out[ts("2024-01-01 10:15:30")] == ts("2024-01-01 10:00:30")   # seconds kept
    assert dict(df.select(half_hour_floor("t")).dtypes).popitem()[1] == "timestamp_ntz"


def test_floor_minutes_keeps_ntz(spark):
    df = spark.createDataFrame([("2024-01-01 10:52:41",)], "s string").select(
        F.col("s").cast("timestamp_ntz").alias("t"))
    r = df.select(floor_minutes("t", 15).alias("f"))
    assert r.dtypes == [("f", "timestamp_ntz")]
    assert r.first().f == ts("2024-01-01 10:45:00")


def test_reporting_week_each_weekday(spark):
    # 2024-01-07 is a Sunday.
    days = [dt.date(2024, 1, 7) + dt.timedelta(days=i) for i in range(7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    s, e = reporting_week(F.col("d"))
    got = {r.d: (r.s, r.e) for r in df.select("d", s.alias("s"), e.alias("e")).collect()}
    for d in days:
        dow = (d.weekday() + 1) % 7  # Sunday = 0
        start = d - dt.timedelta(days=dow + 7)
        end = d - dt.timedelta(days=(dow + 1) % 7)
        assert got[d] == (start, end), d
    # Wednesday: previous complete Sunday-Saturday week.
    assert got[dt.date(2024, 1, 10)] == (dt.date(2023, 12, 31), dt.date(2024, 1, 6))
    # Saturday run: 14-day window ending that Saturday (kept as written).
    assert got[dt.date(2024, 1, 13)] == (dt.date(2023, 12, 31), dt.date(2024, 1, 13))


def test_reporting_week_literal_run_date(spark):
    s, e = reporting_week("2024-01-10")
    r = spark.range(1).select(s.alias("s"), e.alias("e")).first()
    assert (r.s, r.e) == (dt.date(2023, 12, 31), dt.date(2024, 1, 6))


def test_valid_label(spark):
    df = spark.createDataFrame([(None,), ("",), ("Banned",), ("a,b",), ("ok",)], "d string")
    got = [r.d for r in df.filter(valid_label("d", "Banned")).collect()]
    assert got == ["ok"]
    got = sorted(r.d for r in df.filter(valid_label("d", ["Banned", "ok"], separator=None)).collect())
    assert got == ["a,b"]


def test_in_range_end_is_midnight_inclusive(spark):
    df = spark.createDataFrame([("2025-08-31 00:00:00",), ("2025-08-31 09:00:00",),
                                ("2025-07-13 00:00:00",), ("2025-07-12 23:59:59",)], "s string")
    df = df.select(F.col("s").cast("timestamp_ntz").alias("t"))
    got = [r.t for r in df.filter(in_range("t", "2025-07-13", "2025-08-31")).collect()]
    assert sorted(got) == [ts("2025-07-13 00:00:00"), ts("2025-08-31 00:00:00")]
    got = [r.t for r in df.filter(in_range("t", "2025-07-13", "2025-08-31", cutoff="2025-01-12")).collect()]
    assert got == []  # contradictory cutoff: empty, not an error


def test_positive_and_interval(spark):
    df = spark.createDataFrame([(None, 1), (0.0, 2), (-1.0, 3), (2.5, 4)], "v double, i int")
    assert [r.i for r in df.filter(positive("v")).collect()] == [4]
    iv = spark.createDataFrame([(5, 5, 10), (10, 5, 10), (4, 5, 10), (7, None, 10)],
                               "t int, s int, e int")
    assert [r.t for r in iv.filter(within_interval("t", "s", "e")).collect()] == [5]


def test_changed_null_unsafe_and_nullness(spark):
    df = spark.createDataFrame(
        [(1, 1, "a", "a"), (1, 2, "a", "a"), (None, 2, "a", "a"), (None, None, "a", None)],
        "a1 int, b1 int, a2 string, b2 string")
    c = df.select(changed(["a1", "a2"], ["b1", "b2"]).alias("c"),
                  changed(["a1", "a2"], ["b1", "b2"], null_safe=True).alias("cs"),
                  nullness_changed(["a1", "a2"], ["b1", "b2"]).alias("n")).collect()
    assert [r.c for r in c] == [False, True, False, False]     # NULL never counts
    assert [r.cs for r in c] == [False, True, True, True]
    assert [r.n for r in c] == [False, False, True, True]


def test_labels(spark):
    df = spark.createDataFrame([("k1",), ("k2",), ("zz",), (None,)], "c string")
    out = [tuple(r) for r in df.select(label_map("c", {"k1": "One", "k2": "Two"}).alias("l"),
                                       relabel("c", {"k1": "ONE"}).alias("r")).collect()]
    assert out == [("One", "ONE"), ("Two", "k2"), (None, "zz"), (None, None)]
    assert df.select(label_map("c", {"k1": "One"}, default="?").alias("l")).collect()[2].l == "?"


def test_weighted_average_edges(spark):
    # zero total volume; NULL AHT with volume; NULL volume
    df = spark.createDataFrame(
        [("zero", 0.0, 100.0), ("zero", 0.0, 50.0),
         ("nullaht", 10.0, None), ("nullaht", 30.0, 60.0),
         ("nullvol", None, 100.0), ("nullvol", 20.0, 40.0)],
        "g string, vol double, aht double")
    out = dict(rows(df.groupBy("g").agg(weighted_average("aht", "vol").alias("w"))))
    assert out["zero"] is None
    assert out["nullaht"] == 30.0 * 60.0 / 40.0   # the NULL-AHT volume stays in the divisor
    assert out["nullvol"] == 40.0
    r = dict(rows(df.groupBy("g").agg(ratio_of_sums("vol", "aht").alias("r"))))
    assert r["zero"] == 0.0 and r["nullvol"] == 20.0 / 140.0


def test_conditional_counts(spark):
    df = spark.createDataFrame([("Draft",), ("Withdrawn",), ("Live",), (None,)], "s string")
    r = df.agg(count_where(F.col("s") == "Live").alias("w"),
               count_unless(F.col("s").isin("Draft", "Withdrawn")).alias("u")).first()
    assert (r.w, r.u) == (1, 2)   # NULL status counts 1 in the exclude-list form
