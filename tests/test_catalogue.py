"""Every catalogue query against its DuckDB oracle, plus plan-shape checks."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck_connect
from shiftwise.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)  # the corpus operators have tests of their own


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.queries())
    assert set(NAMES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    r = compare(spark, duck, name, E.queries()[name], E.oracle_sql()[name], SF)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["DateTime", "ViewName"]
    assert df.count() > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_evaluation(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_staffing_outlook_plan(spark):
    plan = _plan(E.queries()["staffing_outlook"](spark, SF))
    assert "BroadcastHashJoin" in plan          # size-checked queue map broadcast
    assert "FullOuter" not in plan              # unique stages merged, contract left-joined
    assert "LeftOuter" in plan


def test_outlook_computes_each_fact_stage_once(spark):
    """Executed plan: every grouped source is read once, the contract rows for
    the merge's keys and for the join."""
    df = E.queries()["staffing_outlook"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("+- == Initial Plan ==")[0]
    events = [ln for ln in final.splitlines() if "Scan parquet" in ln and "event_type" in ln]
    assert len(events) == 6


def test_building_queries_starts_no_job(spark):
    """Building a query is lazy, apart from entries whose feature is a write or a count
    that is stored first."""
    writes = {"sync_write_back", "sink_overwrite", "sink_clustered", "payload_tables", "catalog_tables",
              "outlook_job", "catalog_self_replace", "sync_partitions", "sync_partitions_of_stage", "load_stamp",
              "sink_interleaved", "equal_depth_slices", "validity_join_adaptive", "validity_join_merge"}
    tracker = spark.sparkContext.statusTracker()
    for name in NAMES:
        if name in writes:
            continue
        E.queries()[name](spark, SF)  # schemas of the files are read here
        group = f"lazy-{name}"
        spark.sparkContext.setJobGroup(group, name)
        try:
            E.queries()[name](spark, SF)
            jobs = tracker.getJobIdsForGroup(group)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        # Only schema reads of parquet footers (one small job per table read).
        descriptions = {s.name for j in jobs for i in tracker.getJobInfo(j).stageIds
                        if (s := tracker.getStageInfo(i))}
        assert all("parquet" in d for d in descriptions), (name, descriptions)


def test_range_filter_pushed_to_scan(spark):
    plan = _plan(E.queries()["range_filter_inclusive"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan


def test_binned_validity_plan_joins_on_bins(spark):
    plan = _plan(E.queries()["validity_join_binned"](spark, SF))
    assert "__vbin" in plan and "Generate explode(sequence" in plan
