"""The filter of a stage's keys, and the joins that use it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.operators.membership import can_filter, filter_bits, key_filter, may_match, only_possible
from shiftwise.operators.sync import new_rows, sync

SF = "/root/testdata/sf0.001"
NOW = "2025-01-01 00:00:00"


def _tables(spark, n=20_000, m=300):
    target = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("q"), F.col("id") % 7).alias("q"),
                                   (F.col("id") % 5).cast("double").alias("v"))
    stage = spark.range(m).select((F.col("id") * 97).alias("kk"), F.concat(F.lit("q"), F.col("id") * 97 % 7).alias("q"),
                                  F.lit(1.0).alias("v"))
    return target, stage


def test_no_partner_is_ever_dropped_and_most_strangers_are(spark):
    target, stage = _tables(spark)
    for bits in (1 << 13, 1 << 16):
        left = only_possible(target, stage, ["k", "q"], {"k": "kk"}, bits)
        kept = left.count()
        partners = target.join(stage, [target.k == stage.kk, target.q == stage.q], "left_semi").count()
        assert left.join(stage, [left.k == stage.kk, left.q == stage.q], "left_semi").count() == partners == 207
        assert kept < partners + (400 if bits == 1 << 13 else 20)


def test_filter_has_a_fixed_size(spark):
    target, stage = _tables(spark)
    assert len(key_filter(stage, ["kk"], bits=1 << 13).first()[0]) == 128
    assert len(key_filter(stage.limit(0), ["kk"], bits=1 << 13).first()[0]) == 128
    assert only_possible(target, stage.limit(0), ["k"], {"k": "kk"}, 1 << 13).count() == 0
    assert (1 << 13) <= filter_bits(stage) <= (1 << 26)
    with pytest.raises(ValueError):
        key_filter(stage, ["kk"], bits=100)


def test_null_keys_and_types(spark):
    target = spark.createDataFrame([(None, "a"), (1, None), (1, "a")], "k int, q string")
    stage = spark.createDataFrame([(None, "a"), (1, "a"), (2, None)], "k int, q string")
    assert rows(only_possible(target, stage, ["k", "q"], bits=1 << 13)) == [(1, "a")]
    wide = stage.withColumn("k", F.col("k").cast("bigint"))
    assert not can_filter(target, wide, ["k"]) and can_filter(target, stage, ["k"])
    assert only_possible(target, wide, ["k"]).count() == 3  # types differ: no filter
    floats = target.withColumn("k", F.col("k").cast("double"))
    assert not can_filter(floats, floats, ["k"])  # 0.0 and -0.0 are equal and hash apart


def _shuffled_rows(df):
    """Rows written to each shuffle of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    out = []

    def walk(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName() == "Exchange":
            out.append((node.child().toString(), node.metrics().apply("shuffleRecordsWritten").value()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return out


def test_fewer_target_rows_are_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        target, stage = _tables(spark, 50_000)
        plain = new_rows(stage, target, ["k", "q"], {"k": "kk"})
        filtered = new_rows(stage, target, ["k", "q"], {"k": "kk"}, prefilter=True)
        assert rows(filtered) == rows(plain)
        most = lambda df: max(n for text, n in _shuffled_rows(df) if "Range (0, 50000" in text)
        assert most(plain) == 50_000 and most(filtered) < 1_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("policy", ["dimension", "fact", "fact_on_change"])
def test_prefiltered_sync_equals_the_plain_one(spark, policy):
    t0 = dt.datetime(2024, 1, 1)
    target = spark.createDataFrame(
        [(k, "a" if (k or 0) % 3 else None, t0, t0, None if (k or 1) % 4 else t0) for k in [None, None, *range(200)]],
        "k int, v string, RecordCreatedDateTime timestamp_ntz, RecordLastModifiedDateTime timestamp_ntz, "
        "RecordRemovedDateTime timestamp_ntz")
    stage = spark.createDataFrame([(k, "a" if k % 2 else None) for k in range(150, 260)], "id int, v string")
    args = (target, stage, ["k"], ["v"], policy, NOW)
    want = sync(*args, stage_names={"k": "id"})
    assert rows(sync(*args, stage_names={"k": "id"}, prefilter=True)) == rows(want)
    empty = (target, stage.limit(0), ["k"], ["v"], policy, NOW)
    assert rows(sync(*empty, stage_names={"k": "id"}, prefilter=True)) == rows(sync(*empty, stage_names={"k": "id"}))
    assert rows(sync(*empty, stage_names={"k": "id"}, prefilter=True, keep_target_if_stage_empty=True)) == \
        rows(sync(*empty, stage_names={"k": "id"}, keep_target_if_stage_empty=True))


def test_native_filter(spark):
    target, stage = _tables(spark, 100, 10)
    bits = 1 << 13
    out = target.filter(may_match(key_filter(stage, ["kk"], bits=bits).scalar(), ["k"], bits))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastNestedLoopJoin" not in plan
