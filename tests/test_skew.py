"""Hot keys: one key holding a third of the rows must not change results, and
the operators must leave adaptive execution room to split it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.operators import full_outer_chain, latest_per_key, validity_join

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture
def skew_conf(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_facts(spark, n=3000):
    # queue 0 holds a third of all facts, spread over 30 days
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1)
        .cast("int").alias("QueueID"),
        (F.lit(BASE).cast("timestamp_ntz")
         + F.make_dt_interval(F.lit(0), (F.col("id") % 720).cast("int"))).alias("DateTime"),
        F.col("id").alias("fid"))


def test_binned_validity_join_with_hot_queue(spark, skew_conf):
    facts = _hot_facts(spark)
    versions = spark.range(98).select(
        F.col("id").cast("int").alias("QueueID"),
        F.lit(BASE).cast("timestamp_ntz").alias("Start"),
        (F.lit(BASE).cast("timestamp_ntz") + F.make_dt_interval(F.lit(20))).alias("End"))
    binned = validity_join(facts, versions, ["QueueID"], "DateTime", "Start", "End",
                           strategy="binned")
    shuffled = validity_join(facts, versions, ["QueueID"], "DateTime", "Start", "End",
                             strategy="shuffle")
    assert rows(binned, "fid") == rows(shuffled, "fid")
    # the hot queue's rows land in many join groups: one per day bin
    hot_bins = binned.filter("QueueID = 0").select(
        F.datediff(F.to_date("DateTime"), F.lit("1970-01-01").cast("date"))).distinct().count()
    assert hot_bins == 20


def test_outer_chain_hot_key_in_non_unique_frame(spark, skew_conf):
    n = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("k"), F.col("id").alias("mn"))
    u = n.groupBy("k").agg(F.count("*").alias("mu"))
    got = full_outer_chain([u, n], ["k"], unique=[True, False])
    ref = u.join(n, ["k"], "full_outer")
    assert rows(got, "k", "mu", "mn") == rows(ref, "k", "mu", "mn")
    got.write.format("noop").mode("overwrite").save()
    final = got._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in final


def test_latest_per_key_hot_key_is_limited_before_shuffle(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100).alias("k"),
        F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert dict(rows(out, "k", "v"))[0] == 5997


def test_clustered_write_spreads_copies_of_one_row(spark):
    from shiftwise.session import scratch_path
    from shiftwise.sources.sinks import write_clustered

    hot = spark.range(3000).select(F.lit(7).alias("k")).repartition(6)   # 3000 copies
    rest = spark.range(6000).select((F.col("id") % 500).alias("k"))
    path = scratch_path(spark, "copies")
    write_clustered(hot.unionByName(rest), path, ["k"], num_partitions=8)
    back = spark.read.parquet(path)
    assert back.count() == 9000
    files_with_hot = back.filter("k = 7").select(F.input_file_name()).distinct().count()
    assert files_with_hot > 1
    assert rows(back.groupBy("k").count().filter("k = 7")) == [(7, 3012)]


def _group_sizes(facts, hot_rows):
    from shiftwise.operators import validity as V
    split, full = V.hot_bins(facts, ["QueueID"], "DateTime", hot_rows)
    placed = V._placed(facts, split, ["QueueID"]).withColumn(
        V._BIN, V._bin_at(V._seconds(F.col("DateTime")), F.lit(0)))
    dealt = V._salted(placed, full, ["QueueID"], ["fid"])
    return dealt.groupBy("QueueID", V._BIN, "__salt").count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("within", [86_400, 60, 1])  # a key hot within a day, a minute, one second
def test_queue_hot_within_one_day_is_split(spark, skew_conf, within):
    from shiftwise.operators import validity as V
    n, hot_rows = 6000, 200
    second = F.when(F.col("id") % 3 == 0, F.col("id") % within).otherwise(F.col("id") % 200 * 3600)
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).cast("int").alias("QueueID"),
        F.timestamp_seconds(second + 1704067200).cast("timestamp_ntz").alias("DateTime"), F.col("id").alias("fid"))
    versions = spark.range(98).select(
        F.col("id").cast("int").alias("QueueID"), F.lit(BASE).cast("timestamp_ntz").alias("Start"),
        F.lit(dt.datetime(9999, 1, 1)).cast("timestamp_ntz").alias("End"))
    versions = versions.unionByName(versions.filter("QueueID = 0").withColumn(  # and an overlapping one
        "End", F.lit(BASE + dt.timedelta(hours=5)).cast("timestamp_ntz")))
    assert _group_sizes(facts, 10 ** 6) == n // 3
    assert _group_sizes(facts, hot_rows) <= 2 * hot_rows
    expected = rows(validity_join(facts, versions, ["QueueID"], "DateTime", "Start", "End", strategy="shuffle"),
                    "fid", "End")
    for strategy in ("adaptive", "merge"):
        got = validity_join(facts, versions, ["QueueID"], "DateTime", "Start", "End", strategy=strategy,
                            hot=V.stored_hot_bins(facts, ["QueueID"], "DateTime", hot_rows))
        assert rows(got, "fid", "End") == expected


def test_number_of_bins_is_bounded(spark):
    from shiftwise.operators import validity as V
    facts = spark.range(4000).select(F.lit(1).alias("QueueID"), F.timestamp_seconds(
        F.when(F.col("id") < 3000, 0).otherwise(F.col("id") * 100_000)).alias("DateTime"))
    split, full = V.hot_bins(facts, ["QueueID"], "DateTime", 100)
    row = split.first()  # most facts in one second, the others over twelve years
    assert row["bins"] <= 8 * 4000 / 100 and full.count() <= 4000 / 100
    assert V.hot_bins(facts, ["QueueID"], "DateTime", 4000)[0].count() == 0


def test_open_ended_versions_are_not_repeated_by_day(spark):
    """The ordered pass lists a version once for each point it spans: no days."""
    facts = spark.createDataFrame([(1, BASE + dt.timedelta(days=d)) for d in range(0, 3650, 50)],
                                  "k int, at timestamp_ntz")
    versions = spark.createDataFrame([(1, BASE, dt.datetime(9999, 1, 1), "a")],
                                     "k int, s timestamp_ntz, e timestamp_ntz, v string")
    out = validity_join(facts, versions, ["k"], "at", "s", "e", strategy="merge")
    assert out.count() == 73
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__vbin" in plan and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
