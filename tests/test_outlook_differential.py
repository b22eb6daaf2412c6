"""The staffing outlook on random small inputs (NULL keys, duplicate lookup
rows, NULL / negative metrics, boundary stamps) against DuckDB running the
report as plain SQL over the same seven tables."""

import datetime as dt

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.plans import staffing as S

T0 = dt.datetime(2025, 7, 14)
STAMPS = [T0 + dt.timedelta(minutes=15 * i) for i in range(6)] + \
    [dt.datetime(2025, 7, 12, 23, 45), dt.datetime(2025, 8, 31), dt.datetime(2025, 8, 31, 0, 15)]
BOUNDS = [dt.datetime(2025, 7, 1), T0 + dt.timedelta(minutes=30), dt.datetime(2025, 9, 1), None]

SQL = """
WITH fmap AS (SELECT h.QueueID, h.ViewName, m.Partner, m.Site, m.LineOfBusiness, m.ServiceModel,
                     h.s, h.e
              FROM history h JOIN view_map m ON h.ViewName = m.ViewName
              WHERE h.FilterName IN ('F')),
hh AS (SELECT f.*, CASE WHEN minute(f.DateTime) IN (15, 45)
                        THEN f.DateTime - INTERVAL 15 MINUTE ELSE f.DateTime END AS H
       FROM facts f),
stage AS (SELECT f.kind, f.H, f.DateTime, f.v, f.a, m.* EXCLUDE (QueueID, s, e)
          FROM hh f JOIN fmap m ON f.QueueID = m.QueueID AND f.DateTime >= m.s AND f.DateTime < m.e
          WHERE f.DateTime BETWEEN TIMESTAMP '2025-07-13' AND TIMESTAMP '2025-08-31'),
fr AS (SELECT H AS DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
              SUM(v) / 2.0 AS ForecastRequired FROM stage WHERE kind = 'fte' AND v > 0 GROUP BY ALL),
fq AS (SELECT H AS DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
              SUM(v) / 2.0 AS ForecastFTE FROM stage WHERE kind = 'queue' AND v > 0 GROUP BY ALL),
fv AS (SELECT H AS DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
              SUM(v) AS ForecastVolume, SUM(v * a) / NULLIF(SUM(v), 0) AS ForecastAHT
       FROM stage WHERE kind = 'volume' AND v > 0 GROUP BY ALL),
er AS (SELECT DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
              SUM(v) AS ErlangRequired FROM stage WHERE kind = 'model' GROUP BY ALL),
cr AS (SELECT r.DateTime, r.ViewName, m.Partner, m.Site, m.LineOfBusiness, m.ServiceModel,
              r.Required AS ContractRequired
       FROM requirement r JOIN view_map m ON r.ViewName = m.ViewName
       WHERE r.DateTime BETWEEN TIMESTAMP '2025-07-13' AND TIMESTAMP '2025-08-31'
         AND r.Required > 0)
SELECT DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel,
       round(ForecastRequired, 6), round(ForecastFTE, 6), round(ForecastVolume, 6),
       round(ForecastAHT, 6), round(ContractRequired, 6), round(ErlangRequired, 6)
FROM fr FULL JOIN fq USING (DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel)
        FULL JOIN fv USING (DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel)
        FULL JOIN cr USING (DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel)
        FULL JOIN er USING (DateTime, ViewName, Partner, Site, LineOfBusiness, ServiceModel)
"""

maybe = lambda s: st.one_of(st.none(), s)
views_st = st.lists(st.tuples(st.sampled_from(["V1", "V2"]), maybe(st.just("P")),
                              st.sampled_from(["S1", "S2"])), min_size=1, max_size=3)
hist_st = st.lists(st.tuples(st.sampled_from(["F", "G"]), maybe(st.sampled_from(["V1", "V2"])),
                             st.integers(1, 3), st.sampled_from(BOUNDS[:3]),
                             st.sampled_from(BOUNDS[1:])), min_size=1, max_size=5)
facts_st = st.lists(st.tuples(st.sampled_from(["fte", "queue", "volume", "model"]),
                              maybe(st.integers(1, 3)), st.sampled_from(STAMPS),
                              maybe(st.sampled_from([-1.0, 0.0, 1.5, 2.0])),
                              maybe(st.sampled_from([10.0, 20.0]))), max_size=14)
req_st = st.lists(st.tuples(maybe(st.sampled_from(["V1", "V2"])), st.sampled_from(STAMPS),
                            maybe(st.sampled_from([-1.0, 3.0, 4.0]))), max_size=4)


def _ddl(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(views=views_st, hist=hist_st, facts=facts_st, req=req_st)
def test_outlook_matches_sql(spark, views, hist, facts, req):
    vm = [(v, p, s, "L", "M") for v, p, s in views]
    hs = [(f, v, q, s, e) for f, v, q, s, e in hist]
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    frames = {
        "view_map": pd.DataFrame(vm, columns=["ViewName", "Partner", "Site", "LineOfBusiness",
                                              "ServiceModel"]),
        "history": pd.DataFrame(hs, columns=["FilterName", "ViewName", "QueueID", "s", "e"]),
        "facts": pd.DataFrame(facts, columns=["kind", "QueueID", "DateTime", "v", "a"]),
        "requirement": pd.DataFrame(req, columns=["ViewName", "DateTime", "Required"]),
    }
    types = {"view_map": "ViewName VARCHAR, Partner VARCHAR, Site VARCHAR, LineOfBusiness VARCHAR, ServiceModel VARCHAR",
             "history": "FilterName VARCHAR, ViewName VARCHAR, QueueID INTEGER, s TIMESTAMP, e TIMESTAMP",
             "facts": "kind VARCHAR, QueueID INTEGER, DateTime TIMESTAMP, v DOUBLE, a DOUBLE",
             "requirement": "ViewName VARCHAR, DateTime TIMESTAMP, Required DOUBLE"}
    for name, pdf in frames.items():
        con.execute(f"CREATE TABLE {name} ({types[name]})")
        if len(pdf):
            con.register("_tmp", pdf)
            con.execute(f"INSERT INTO {name} SELECT * FROM _tmp")
            con.unregister("_tmp")
    expected = sorted(con.execute(SQL).fetchall(),
                      key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))

    tsn = "timestamp_ntz"
    history = _ddl(spark, hs, f"FilterName string, ViewName string, QueueID int, "
                              f"RecordStartDateInclusive {tsn}, RecordEndDateNonInclusive {tsn}")
    view_map = _ddl(spark, vm, "ViewName string, Partner string, Site string, "
                               "LineOfBusiness string, ServiceModel string")

    def kind(k, cols):
        return [(q, t, v) if cols == 3 else (q, t, v, a) for kk, q, t, v, a in facts if kk == k]
    fte = _ddl(spark, kind("fte", 3), f"QueueID int, DateTime {tsn}, FTE double")
    queue = _ddl(spark, kind("queue", 3), f"QueueID int, DateTime {tsn}, AFTE double")
    volume = _ddl(spark, kind("volume", 4), f"QueueID int, DateTime {tsn}, CALLVOLUME double, AHT double")
    model = _ddl(spark, kind("model", 3), f"QueueID int, DateTime {tsn}, Required double")
    requirement = _ddl(spark, req, f"ViewName string, DateTime {tsn}, Required double")
    out = S.staffing_outlook(history, view_map, fte, queue, volume, requirement, model,
                             "2025-07-13", "2025-08-31", ["F"], now="2030-01-01")
    got = rows(out.select(*S.REPORT_KEYS, *[F.round(m, 6).alias(m) for m in S.METRICS]))
    assert got == expected

