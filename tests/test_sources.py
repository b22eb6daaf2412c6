"""Readers and writers."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.session import scratch_path
from shiftwise.sources import jdbc_options, read_source, write_clustered, write_table

SF = "/root/testdata/sf0.001"


def test_read_source_parquet_prunes_columns(spark):
    df = read_source(spark, "parquet", f"{SF}/nation.parquet", columns=["n_nationkey"])
    assert df.columns == ["n_nationkey"] and df.count() == 25
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n_nationkey:int>" in plan


def test_read_source_table_and_unknown(spark):
    spark.read.parquet(f"{SF}/region.parquet").createOrReplaceTempView("region_src")
    assert read_source(spark, "table", "region_src").count() == 5
    with pytest.raises(ValueError):
        read_source(spark, "mystery", "x")


def test_jdbc_options():
    o = jdbc_options("jdbc:x://h/db", table="dbo.t", partition_column="id", lower_bound=0,
                     upper_bound=1000, num_partitions=16)
    assert o["dbtable"] == "dbo.t" and o["numPartitions"] == "16" and o["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", table="t", query="select 1")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h/db", table="t", partition_column="id")


def test_write_table_modes_tag_and_staged_self_replace(spark):
    path = scratch_path(spark, "t")
    nation = spark.read.parquet(f"{SF}/nation.parquet")
    write_table(nation, path, mode="overwrite", source_system="sys-a")
    assert spark.read.parquet(path).filter(F.col("source_system") == "sys-a").count() == 25
    write_table(nation.limit(3), path, mode="append", source_system="sys-b")
    assert spark.read.parquet(path).count() == 28
    # read the target and overwrite it: staged through the checkpoint folder
    current = spark.read.parquet(path)
    write_table(current.filter(F.col("source_system") == "sys-b").drop("source_system"),
                path, mode="overwrite", source_system="sys-c", staged=True)
    after = spark.read.parquet(path)
    assert after.count() == 3 and rows(after.select("source_system").distinct()) == [("sys-c",)]
    with pytest.raises(ValueError):
        write_table(nation, path, mode="upsert")


def test_write_clustered_sorted_ranges(spark):
    path = scratch_path(spark, "c")
    df = spark.range(0, 2000).select((F.col("id") * 7919 % 2000).alias("k"), F.col("id"))
    write_clustered(df, path, ["k"], num_partitions=4)
    back = spark.read.parquet(path)
    assert back.count() == 2000
    per_file = back.withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("lo").collect()
    assert len(per_file) >= 2
    for a, b in zip(per_file, per_file[1:]):
        assert a.hi < b.lo   # files hold disjoint key ranges


def test_write_table_dynamic_partition_overwrite(spark):
    path = scratch_path(spark, "parts")
    df = spark.createDataFrame([("d1", 1), ("d2", 2), ("d3", 3)], "day string, v int")
    write_table(df, path, partition_by=["day"])
    fresh = spark.createDataFrame([("d2", 20)], "day string, v int")
    write_table(fresh, path, partition_by=["day"], dynamic_partitions=True)
    assert rows(spark.read.parquet(path), "day", "v") == [("d1", 1), ("d2", 20), ("d3", 3)]
    with pytest.raises(ValueError):
        write_table(fresh, path, dynamic_partitions=True)


def test_jdbc_date_predicates():
    from shiftwise.sources import jdbc_date_predicates
    preds = jdbc_date_predicates("DateTime", "2025-07-13", "2025-07-20", days_per_slice=3)
    assert preds == [
        "DateTime >= '2025-07-13 00:00:00' AND DateTime < '2025-07-16 00:00:00'",
        "DateTime >= '2025-07-16 00:00:00' AND DateTime < '2025-07-19 00:00:00'",
        "DateTime >= '2025-07-19 00:00:00' AND DateTime <= '2025-07-20 00:00:00'",
    ]
    # Times of day count, the end is inclusive, NULLs get a slice when asked for.
    assert jdbc_date_predicates("d", "2023-04-06 12:00:00", "2023-04-07 18:00:00", with_nulls=True) == [
        "d >= '2023-04-06 12:00:00' AND d < '2023-04-07 12:00:00'",
        "d >= '2023-04-07 12:00:00' AND d <= '2023-04-07 18:00:00'",
        "d IS NULL",
    ]
    with pytest.raises(ValueError):
        jdbc_date_predicates("d", "2025-01-02", "2025-01-01")


def test_jdbc_predicates_cover_the_range_once(spark):
    """Every stamp of the inclusive range (and no other) passes one clause."""
    from shiftwise.sources import jdbc_date_predicates
    df = spark.range(0, 200).select(
        (F.lit("2023-04-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("d"))
    preds = jdbc_date_predicates("d", "2023-04-02 05:00:00", "2023-04-07 18:00:00", days_per_slice=2)
    hits = sum(F.expr(p).cast("int") for p in preds)
    got = {r["h"]: r["count"] for r in df.groupBy(hits.alias("h")).count().collect()}
    assert got == {1: 5 * 24 + 14, 0: 200 - 5 * 24 - 14}


def test_jdbc_read_arguments_take_either_spelling():
    from shiftwise.sources.readers import jdbc_read_arguments
    same = {"url": "u", "fetchsize": "10000", "dbtable": "t", "partitionColumn": "id",
            "lowerBound": "0", "upperBound": "9", "numPartitions": "4"}
    assert jdbc_read_arguments(url="u", table="t", partition_column="id", lower_bound=0, upper_bound=9,
                               num_partitions=4) == same
    assert jdbc_read_arguments(url="u", dbtable="t", partitionColumn="id", lowerBound=0, upperBound=9,
                               numPartitions=4) == same
    assert jdbc_read_arguments(["a = 1"], url="u", query="select 1")["dbtable"] == "(select 1) q"
    with pytest.raises(ValueError):
        jdbc_read_arguments(["a = 1"], url="u", table="t", partition_column="id", lower_bound=0,
                            upper_bound=9, num_partitions=4)


def test_jdbc_sync_target_options():
    from shiftwise.plans.synchronise import jdbc_target
    opts = {"url": "u", "user": "x", "numPartitions": "4"}
    assert jdbc_target("t", opts) == {**opts, "dbtable": "t"}
    assert jdbc_target("t", opts, write=True) == {"url": "u", "user": "x", "dbtable": "t"}
    with pytest.raises(ValueError):
        jdbc_target("t", None)


def test_failed_staged_write_leaves_the_target_whole(spark):
    import os
    path = scratch_path(spark, "staged")
    write_table(spark.range(10), path)
    bad = spark.read.parquet(path).select(
        F.when(F.col("id") > 5, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_table(bad, path, staged=True)
    assert spark.read.parquet(path).count() == 10
    local = path.removeprefix("file:")
    assert os.listdir(os.path.dirname(local)).count(os.path.basename(local)) == 1
    assert not [x for x in os.listdir(os.path.dirname(local)) if x.startswith("_" + os.path.basename(local))]
    write_table(spark.read.parquet(path).filter("id < 4"), path, staged=True)
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError):
        write_table(spark.range(1), path, mode="append", staged=True)


def test_staged_write_of_a_catalog_table(spark):
    write_table(spark.range(10), "staged_table")
    write_table(spark.table("staged_table").filter("id >= 7"), "staged_table", staged=True)
    assert rows(spark.table("staged_table"), "id") == [(7,), (8,), (9,)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_table")] == ["staged_table"]


def test_scratch_is_removed(spark):
    import os
    from shiftwise.session import release_scratch
    path = scratch_path(spark, "gone")
    write_table(spark.range(3), path)
    release_scratch(spark)
    assert not os.path.exists(path.removeprefix("file:"))


def test_jdbc_write_options_and_mode_check(spark):
    from shiftwise.sources import jdbc_write_options, write_jdbc
    o = jdbc_write_options({"url": "jdbc:x://h/db", "dbtable": "t", "batchsize": 500},
                           num_partitions=8)
    assert o == {"url": "jdbc:x://h/db", "dbtable": "t", "batchsize": "500",
                 "truncate": "true", "numPartitions": "8"}
    assert "truncate" not in jdbc_write_options({"url": "u"}, mode="append")
    with pytest.raises(ValueError):   # rejected before any connection is opened
        write_jdbc(spark.range(1), {"url": "jdbc:x://h/db", "dbtable": "t"}, mode="upsert")


def _skewed(spark, n=20_000):
    """Half of the rows in the first hour, a tenth on one instant, some without a time."""
    at = F.when(F.col("id") % 2 == 0, F.col("id") % 3600).when(F.col("id") % 10 == 1, F.lit(5_000_000)) \
        .otherwise(F.col("id") * 977 % 10_000_000)
    return spark.range(n).select(
        "id", F.when(F.col("id") % 97 != 0, F.timestamp_seconds(at + 1_700_000_000).cast("timestamp_ntz")).alias("at"),
        (at * at).alias("num"), F.to_date(F.timestamp_seconds(at + 1_700_000_000)).alias("day"))


@pytest.mark.parametrize("column", ["at", "num", "day"])
def test_equal_depth_slices_of_a_skewed_column(spark, column):
    from shiftwise.sources.readers import equal_depth_cuts, jdbc_cut_predicates
    df = _skewed(spark)
    predicates = jdbc_cut_predicates(column, equal_depth_cuts(df, column, 10))
    parts = [df.filter(p) for p in predicates]
    ids = [r["id"] for p in parts for r in p.select("id").collect()]
    assert sorted(ids) == list(range(20_000))  # every row, exactly once
    if column != "day":
        assert max(p.count() for p in parts) <= 2 * 20_000 / 10
        # Equal days (or ranges) put half of the rows into one slice.
        lo, hi = df.agg(F.min("num"), F.max("num")).first()
        width = (hi - lo) / 10
        assert max(r["count"] for r in df.groupBy(F.floor((F.col("num") - lo) / width)).count().collect()) > 9_000


def test_cut_predicates():
    import datetime as dt
    from shiftwise.sources.readers import jdbc_cut_predicates
    assert jdbc_cut_predicates("x", [3, 5]) == ["x < 3", "x >= 3 AND x < 5", "x >= 5", "x IS NULL"]
    assert jdbc_cut_predicates("x", [3, 5, 3], with_nulls=False) == ["x < 3", "x = 3", "x > 3 AND x < 5", "x >= 5"]
    assert jdbc_cut_predicates("x", []) == ["x IS NOT NULL", "x IS NULL"]
    assert jdbc_cut_predicates("x", [3, 50], with_nulls=False, start=2, end=9) == ["x >= 2 AND x < 3", "x >= 3 AND x <= 9"]
    assert jdbc_cut_predicates("t", [dt.datetime(2024, 1, 2, 3)], with_nulls=False) == [
        "t < '2024-01-02 03:00:00'", "t >= '2024-01-02 03:00:00'"]
    with pytest.raises(ValueError):
        jdbc_cut_predicates("x", ["1 OR 1=1"])


def test_equal_depth_cuts_of_nothing(spark):
    from shiftwise.sources.readers import equal_depth_cuts
    df = _skewed(spark, 10)
    assert equal_depth_cuts(df.limit(0), "num", 4) == [] == equal_depth_cuts(df, "num", 1)
    with pytest.raises(ValueError):
        equal_depth_cuts(df, "num", 0)


def _files_met(spark, path, column, values):
    """Mean share of files whose minimum and maximum admit a value of the column."""
    per_file = spark.read.parquet(path).withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.min(column).alias("lo"), F.max(column).alias("hi")).collect()
    return sum(sum(r["lo"] <= v <= r["hi"] for r in per_file) for v in values) / len(values) / len(per_file)


def test_interleaved_files_are_narrow_in_every_column(spark):
    from shiftwise.sources.sinks import write_interleaved
    df = spark.range(0, 40_000).select(
        (F.col("id") * 7919 % 40_000).alias("k"),
        F.concat(F.lit("VIEW_"), F.lpad((F.col("id") * 104729 % 1000).cast("string"), 4, "0")).alias("v"),
        F.timestamp_seconds(F.col("id") * 31 % 40_000).alias("t"))
    by_key, both = scratch_path(spark, "by_key"), scratch_path(spark, "both")
    write_clustered(df, by_key, ["k", "v"], num_partitions=16)
    write_interleaved(df, both, ["k", "v"], num_partitions=16)
    back = spark.read.parquet(both)
    assert back.columns == df.columns and rows(back) == rows(df)
    ks, vs = range(500, 40_000, 4_000), [f"VIEW_{i:04d}" for i in range(50, 1000, 100)]
    assert _files_met(spark, by_key, "v", vs) > 0.95           # sorted by k: every file has every view
    assert _files_met(spark, both, "v", vs) < 0.45 and _files_met(spark, both, "k", ks) < 0.45


def test_interleaved_key_of_awkward_columns(spark):
    from shiftwise.sources.sinks import interleaved_key, write_interleaved
    df = spark.createDataFrame([(None, None, 1.0), ("a", 1, None), ("", 2, float("inf")), ("a", 1, -1.0), ("é", 3, 0.0)],
                               "s string, n int, d double")
    path = scratch_path(spark, "odd")
    write_interleaved(df, path, ["s", "n", "d"], bits=3)
    assert rows(spark.read.parquet(path)) == rows(df)
    write_interleaved(df.limit(0), path, ["s"])
    assert spark.read.parquet(path).count() == 0
    same = spark.range(1000).select(F.lit("x").alias("s"), F.lit(1).alias("n"))  # one value: spread by its rows
    write_interleaved(same.withColumn("id", F.monotonically_increasing_id()), path, ["s", "n"], num_partitions=4)
    assert spark.read.parquet(path).rdd.getNumPartitions() >= 1 and spark.read.parquet(path).count() == 1000
    with pytest.raises(ValueError):
        interleaved_key(df, ["s"] * 11)
