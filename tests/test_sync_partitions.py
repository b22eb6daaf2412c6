"""Syncs that rewrite only the partitions a stage changes."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.operators.sync import sync
from shiftwise.plans import synchronise as Y
from shiftwise.session import scratch_path
from shiftwise.sources import sinks
from shiftwise.sources.sinks import list_partitions, partition_values, resume_swaps, write_table

NOW = "2025-01-01 00:00:00"
KEYS, VALUES = ["at", "queue"], ["aht", "volume"]
TARGET = ("at timestamp_ntz, queue int, aht double, volume double, RecordCreatedDateTime timestamp_ntz, "
          "RecordLastModifiedDateTime timestamp_ntz, RecordRemovedDateTime timestamp_ntz")
STAGE = "ForecastInterval timestamp_ntz, queue int, aht double, volume double"
NAMES = {"at": "ForecastInterval"}
BY_DAY = {"day": "to_date(at)"}
T0 = dt.datetime(2024, 1, 1)


def _at(day, hour=0):
    return T0 + dt.timedelta(days=day, hours=hour)


def _frames(spark, seed, days=8):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 1.0, 2.0])
    target = [(_at(d, h), q, value(), value(), T0, T0, rng.choice([None, T0]))
              for d in range(days) for h in (0, 7) for q in range(3) if rng.random() < 0.8]
    stage = []
    for at, q, aht, volume, *_ in target:
        day = (at - T0).days
        if day in (2, 3):  # unchanged
            stage.append((at, q, aht, volume))
        elif day in (4, 5, 6) and rng.random() < 0.7:
            stage.append((at, q, value(), value()))
    stage += [(_at(d, 9), 7, value(), value()) for d in (5, days, days + 1)]
    return spark.createDataFrame(target, TARGET), spark.createDataFrame(stage, STAGE)


def _files(path):
    """Modification time of every data file, by its path below ``path``."""
    local = path.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, f), local): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(local) for f in names if f.endswith(".parquet")}


def _run(spark, target, stage, policy, partition=None, **options):
    path = scratch_path(spark, "target")
    Y.write_partitioned(target, path, partition or BY_DAY)
    before = _files(path)
    report = Y.sync_partitions(spark, path, stage, KEYS, VALUES, policy, NOW, target.schema, partition or BY_DAY,
                               stage_names=NAMES, **options)
    back = Y.read_partitioned(spark, path, target.schema, partition or BY_DAY)
    return path, before, report, back


def _full(target, stage, policy, **options):
    return sync(target, stage, KEYS, VALUES, policy, NOW, stage_names=NAMES, **options)


@pytest.mark.parametrize("policy, options", [
    ("fact", {}), ("fact_on_change", {}), ("fact_on_change", {"on_change": "value"}), ("dimension", {}),
    ("dimension", {"revive_only": True})])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_full_rewrite(spark, policy, options, seed):
    target, stage = _frames(spark, seed)
    path, before, report, back = _run(spark, target, stage, policy, **options)
    assert rows(back.drop("day")) == rows(_full(target, stage, policy, **options))
    assert {p[0] for p in report.rewritten + report.kept} == {r["day"] for r in back.select("day").distinct().collect()}
    after = _files(path)
    for (day,) in report.kept:
        mine = [f for f in before if f.startswith(f"day={day}/")]
        assert mine and all(after[f] == before[f] for f in mine)
    for (day,) in report.dropped:
        assert not any(f.startswith(f"day={day}/") for f in after)
    if policy == "fact_on_change":
        assert {"2024-01-03", "2024-01-04"} <= {p[0] for p in report.kept}
        assert {"2024-01-01", "2024-01-02"} <= {p[0] for p in report.dropped}
    assert not [n for n in os.listdir(os.path.dirname(path.removeprefix("file:"))) if n.startswith("_target")]


@pytest.mark.parametrize("policy", ["fact", "fact_on_change", "dimension"])
def test_scope_of_the_stage_leaves_other_partitions_alone(spark, policy):
    target, stage = _frames(spark, 3)
    path, before, report, back = _run(spark, target, stage, policy, scope="stage")
    days = [r[0] for r in stage.select(F.to_date("ForecastInterval").cast("string")).distinct().collect()]
    inside = F.to_date("at").cast("string").isin(days)
    want = _full(target.filter(inside), stage, policy).unionByName(target.filter(~inside))
    assert rows(back.drop("day")) == rows(want)
    assert {("2024-01-01",), ("2024-01-02",), ("2024-01-08",)} <= set(report.kept) and not report.dropped
    after = _files(path)
    assert all(after[f] == before[f] for f in before if f.startswith(("day=2024-01-01/", "day=2024-01-08/")))


def test_second_run_changes_nothing(spark):
    target, stage = _frames(spark, 4)
    path, _, _, back = _run(spark, target, stage, "fact_on_change", on_change="value")
    first, state = _files(path), rows(back)
    again = Y.sync_partitions(spark, path, stage.filter("aht is not null and volume is not null").unionByName(
        stage.filter("aht is null or volume is null")), KEYS, VALUES, "fact_on_change", NOW, target.schema, BY_DAY,
        stage_names=NAMES, on_change="nullness")
    assert again.rewritten == [] or rows(Y.read_partitioned(spark, path, target.schema, BY_DAY)) == state
    assert set(first) >= {f for f in _files(path)} or again.rewritten


def test_two_levels_nulls_and_odd_names(spark):
    partition = {"day": "to_date(at)", "half": "concat('h:', cast(queue % 2 as string))"}
    target, stage = _frames(spark, 5)
    target = target.unionByName(spark.createDataFrame([(None, 1, 1.0, 1.0, T0, T0, None),
                                                       (None, None, 2.0, 2.0, T0, T0, None)], TARGET))
    _, _, report, back = _run(spark, target, stage, "dimension", partition=partition)
    assert rows(back.drop(*partition)) == rows(_full(target, stage, "dimension"))
    assert (None, "h:1") in report.rewritten and (None, None) in report.rewritten
    _, _, report, back = _run(spark, target, stage, "fact", partition=partition)
    assert rows(back.drop(*partition)) == rows(_full(target, stage, "fact"))
    assert (None, None) in report.dropped


def test_empty_stage(spark):
    target, stage = _frames(spark, 6)
    none = stage.limit(0)
    _, _, report, back = _run(spark, target, none, "fact")
    assert back.count() == 0 and len(report.dropped) == 8
    _, before, report, back = _run(spark, target, none, "fact", keep_target_if_stage_empty=True)
    assert rows(back.drop("day")) == rows(target) and not report.dropped


def test_only_listed_partitions_are_scanned(spark):
    target, _ = _frames(spark, 7)
    path = scratch_path(spark, "target")
    Y.write_partitioned(target, path, BY_DAY)
    read = Y.read_partitioned(spark, path, target.schema, BY_DAY).filter(Y._is_one_of(BY_DAY, [("2024-01-03",)]))
    assert len(read.inputFiles()) >= 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    assert {r["day"] for r in read.select("day").distinct().collect()} == {"2024-01-03"}


def test_misplaced_row_fails(spark):
    target, stage = _frames(spark, 8)
    path = scratch_path(spark, "target")
    Y.write_partitioned(target, path, {"day": "date_add(to_date(at), 1)"})
    with pytest.raises(Exception, match="lies in a partition"):
        Y.sync_partitions(spark, path, stage, KEYS, VALUES, "fact", NOW, target.schema, BY_DAY, stage_names=NAMES)


def test_repeated_and_null_stage_keys_fail_and_touch_nothing(spark):
    target, stage = _frames(spark, 9)
    path = scratch_path(spark, "target")
    Y.write_partitioned(target, path, BY_DAY)
    before = _files(path)
    for bad, message in ((stage.unionByName(stage), "repeated key"),
                         (stage.withColumn("queue", F.lit(None).cast("int")), "NULL in key")):
        with pytest.raises(Exception, match=message):
            Y.sync_partitions(spark, path, bad, KEYS, VALUES, "fact", NOW, target.schema, BY_DAY, stage_names=NAMES)
    assert _files(path) == before


def _parts(spark, path):
    return {r["day"]: r["v"] for r in spark.read.schema("v int, day string").parquet(path).collect()}


def test_staged_partitions_are_swapped_one_by_one(spark):
    path = scratch_path(spark, "parts")
    write_table(spark.createDataFrame([("d1", 1), ("d2", 2), ("d:3", 3)], "day string, v int"), path, partition_by=["day"])
    current = spark.read.parquet(path)
    new = current.filter("day <> 'd1'").withColumn("v", F.col("v") * 10)  # reads what it replaces
    write_table(new, path, partition_by=["day"], staged=True, dynamic_partitions=True)
    assert _parts(spark, path) == {"d1": 1, "d2": 20, "d:3": 30}
    assert sorted(map(partition_values, list_partitions(spark, path))) == [("d1",), ("d2",), ("d:3",)]
    with pytest.raises(ValueError, match="path"):
        write_table(new, "some_table", partition_by=["day"], staged=True, dynamic_partitions=True)


def test_failed_swap_is_undone(spark, monkeypatch):
    path = scratch_path(spark, "parts")
    frame = lambda n: spark.createDataFrame([(f"d{i}", i * n) for i in range(4)], "day string, v int")
    write_table(frame(1), path, partition_by=["day"])
    stage = sinks._beside(path, "stage")
    write_table(frame(10), stage, partition_by=["day"])
    real = sinks.file_system

    class Failing:
        def __init__(self, fs):
            self.fs, self.n = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            self.n += 1
            return False if self.n == 6 else self.fs.rename(a, b)

    fs, cls = real(spark, path)
    monkeypatch.setattr(sinks, "file_system", lambda *_: (Failing(fs), cls))
    with pytest.raises(OSError):
        sinks.swap_partitions(spark, stage, path)
    monkeypatch.setattr(sinks, "file_system", real)
    spark.catalog.refreshByPath(path)
    assert _parts(spark, path) == {f"d{i}": i for i in range(4)}
    assert len(list_partitions(spark, stage)) == 4  # nothing lost: the swap can be tried again
    assert resume_swaps(spark, path) == 1
    assert _parts(spark, path) == {f"d{i}": i * 10 for i in range(4)}


def test_a_stopped_swap_is_finished(spark):
    path = scratch_path(spark, "parts")
    frame = lambda n: spark.createDataFrame([(f"d{i}", i * n) for i in range(1, 5)], "day string, v int")
    write_table(frame(1), path, partition_by=["day"])
    stage = sinks._beside(path, "stage")
    write_table(frame(10).filter("day < 'd4'"), stage, partition_by=["day"])
    fs, cls = sinks.file_system(spark, path)
    stream = fs.create(cls(f"{stage}/_drop"), True)
    stream.write(bytearray(b"day=d4"))
    stream.close()
    # Stopped after d1 was swapped and d2 moved away.
    fs.mkdirs(cls(f"{stage}_old"))
    for a, b in ((f"{path}/day=d1", f"{stage}_old/day=d1"), (f"{stage}/day=d1", f"{path}/day=d1"),
                 (f"{path}/day=d2", f"{stage}_old/day=d2")):
        assert fs.rename(cls(a), cls(b))
    unfinished = sinks._beside(path, "stage")
    fs.mkdirs(cls(f"{unfinished}/day=d9"))
    assert resume_swaps(spark, path) == 1
    assert _parts(spark, path) == {"d1": 10, "d2": 20, "d3": 30}
    assert resume_swaps(spark, path) == 0 and not fs.exists(cls(unfinished))
