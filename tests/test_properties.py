"""Property checks on generated inputs (small example counts: every example
runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.operators import full_outer_chain, unpivot_slots, validity_join
from shiftwise.operators.reshape import slot_columns

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])
BASE = dt.datetime(2024, 1, 1)

versions_st = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 12),
              st.booleans()),
    max_size=8)
facts_st = st.lists(st.tuples(st.integers(0, 4), st.integers(-2, 36), st.integers(0, 23)),
                    max_size=25)


@SETTINGS
@given(versions=versions_st, facts=facts_st)
def test_validity_strategies_agree(spark, versions, facts):
    v = spark.createDataFrame(
        [(q, i, BASE + dt.timedelta(days=s), None if nul else BASE + dt.timedelta(days=s + n))
         for i, (q, s, n, nul) in enumerate(versions)],
        "QueueID int, vid int, Start timestamp_ntz, End timestamp_ntz")
    f = spark.createDataFrame(
        [(q, BASE + dt.timedelta(days=d, hours=h), j) for j, (q, d, h) in enumerate(facts)],
        "QueueID int, DateTime timestamp_ntz, fid int")
    expected = sorted(
        (fid, vid)
        for fid, (fq, fd, fh) in enumerate(facts)
        for vid, (vq, s, n, nul) in enumerate(versions)
        if fq == vq and not nul and s <= fd + fh / 24 < s + n)
    for strategy in ("broadcast", "shuffle", "binned"):
        out = validity_join(f, v, ["QueueID"], "DateTime", "Start", "End", strategy=strategy)
        assert rows(out, "fid", "vid") == expected, strategy


spans_st = st.lists(st.tuples(st.sampled_from([0, 0, 1, None]), st.integers(0, 30),
                              st.sampled_from([1, 2, 5, 40, None, 10 ** 6])), max_size=10)
times_st = st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, None]), st.sampled_from([None, *range(0, 40, 2)])), max_size=30)


@settings(SETTINGS, max_examples=8)
@given(spans=spans_st, times=times_st)
def test_ordered_pass_with_overlapping_and_open_ended_versions(spark, spans, times):
    minute = dt.timedelta(minutes=1)
    v = spark.createDataFrame([(k, i, BASE + s * minute, None if n is None else BASE + (s + n) * minute)
                               for i, (k, s, n) in enumerate(spans)], "k int, vid int, s timestamp_ntz, e timestamp_ntz")
    f = spark.createDataFrame([(k, None if t is None else BASE + t * minute, i) for i, (k, t) in enumerate(times)],
                              "k int, at timestamp_ntz, fid int")
    expected = sorted((i, j) for i, (k, t) in enumerate(times) for j, (q, s, n) in enumerate(spans)
                      if k is not None and k == q and t is not None and n is not None and s <= t < s + n)
    for strategy, hot_rows in (("merge", 10 ** 6), ("merge", 2), ("adaptive", 2)):
        out = validity_join(f, v, ["k"], "at", "s", "e", strategy=strategy, hot_rows=hot_rows)
        assert rows(out, "fid", "vid") == expected, (strategy, hot_rows)


keyed_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 9)),
                    max_size=6)


@SETTINGS
@given(a=keyed_st, b=keyed_st, c=keyed_st)
def test_full_outer_chain_fast_path_agrees(spark, a, b, c):
    def frame(data, name, unique):
        seen = set()
        kept = [r for r in data if not unique or not (r[0] in seen or seen.add(r[0]))]
        return spark.createDataFrame(kept, f"k string, {name} int")
    fa, fb, fc = frame(a, "ma", True), frame(b, "mb", False), frame(c, "mc", True)
    ref = fa.join(fb, ["k"], "full_outer").join(fc, ["k"], "full_outer")
    got = full_outer_chain([fa, fb, fc], ["k"], unique=[True, False, True])
    assert rows(got, "k", "ma", "mb", "mc") == rows(ref, "k", "ma", "mb", "mc")


@SETTINGS
@given(n_rows=st.integers(0, 5), n_slots=st.integers(1, 8))
def test_unpivot_row_count(spark, n_rows, n_slots):
    cols = [f"A{i} double" for i in range(1, n_slots + 1)] + \
        [f"V{i} double" for i in range(1, n_slots + 1)]
    data = [tuple([r] + [float(r * 100 + i) for i in range(2 * n_slots)]) for r in range(n_rows)]
    df = spark.createDataFrame(data, "id int, " + ", ".join(cols))
    out = unpivot_slots(df, ["id"], {"AHT": slot_columns("A", n_slots),
                                     "CallVolume": slot_columns("V", n_slots)})
    assert out.count() == n_rows * n_slots
    # slot i pairs A_i with V_i of the same row
    for r in out.filter(F.col("id") == 0).collect():
        assert r.CallVolume - r.AHT == n_slots


def test_except_distinct_dups_and_nulls(spark):
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (2, None), (3, "z"), (None, None)],
                                 "k int, v string")
    right = spark.createDataFrame([(3, "z"), (None, None)], "k int, v string")
    out = left.subtract(right)   # EXCEPT DISTINCT: duplicates collapse, NULLs compare equal
    assert rows(out) == [(1, "x"), (2, None)]


NOW_TS = dt.datetime(2030, 1, 1)
OLD = dt.datetime(2020, 1, 1)
val_st = st.one_of(st.none(), st.integers(0, 2))
target_st = st.dictionaries(st.integers(0, 8), st.tuples(val_st, val_st, st.booleans()),
                            max_size=7)
stage_st = st.dictionaries(st.integers(0, 8), st.tuples(val_st, val_st), max_size=7)


def _model(policy, target, stage):
    """Brute-force reference of the three sync policies (one dict per key)."""
    out = {}
    for k in set(target) | set(stage):
        t, s = target.get(k), stage.get(k)
        if t is not None and s is None:
            if policy == "dimension":
                out[k] = (t[0], t[1], OLD, OLD, NOW_TS)
            continue
        if t is None:
            out[k] = (s[0], s[1], NOW_TS, NOW_TS, None)
            continue
        removed = OLD if t[2] else None
        if policy == "dimension":
            diff = any(a is not None and b is not None and a != b for a, b in zip(t[:2], s))
            upd = diff or removed is None
            out[k] = (s[0], s[1], OLD, NOW_TS, None) if upd else (t[0], t[1], OLD, OLD, removed)
        else:
            upd = policy == "fact" or any((a is None) != (b is None) for a, b in zip(t[:2], s))
            new = tuple(b if b is not None else a for a, b in zip(t[:2], s))
            out[k] = (*new, OLD, NOW_TS, removed) if upd else (t[0], t[1], OLD, OLD, removed)
    return out


@SETTINGS
@given(target=target_st, stage=stage_st)
def test_sync_matches_brute_force(spark, target, stage):
    from shiftwise.operators.sync import sync
    tdf = spark.createDataFrame(
        [(k, a, b, OLD, OLD, OLD if r else None) for k, (a, b, r) in target.items()],
        "k int, a int, b int, c timestamp_ntz, m timestamp_ntz, r timestamp_ntz")
    sdf = spark.createDataFrame([(k, a, b) for k, (a, b) in stage.items()], "k int, a int, b int")
    for policy in ("dimension", "fact", "fact_on_change"):
        got = sync(tdf, sdf, ["k"], ["a", "b"], policy, "2030-01-01 00:00:00",
                   created="c", modified="m", removed="r")
        expected = _model(policy, target, stage)
        assert {r.k: (r.a, r.b, r.c, r.m, r.r) for r in got.collect()} == expected, policy
        assert got.count() == len(expected)   # one row per key


def _parse_model(schema, text):
    """Plain-Python statement of the payload rules: strip, split lines, drop a
    header equal to the schema (spaces ignored), split and strip fields."""
    norm = schema.replace(" ", "")
    lines = text.strip().split("\n")
    start = 1 if lines[0].replace(" ", "") == norm else 0
    return [(norm, i, [v.strip() for v in lines[i].split(",")]) for i in range(start, len(lines))]


field_st = st.text(alphabet="ab1 ", max_size=4)
line_st = st.lists(field_st, min_size=1, max_size=3).map(",".join)
payload_st = st.tuples(st.sampled_from(["a,b", "a, b", "x"]),
                       st.lists(line_st, min_size=1, max_size=4),
                       st.booleans(), st.sampled_from(["\n", "\r\n"]), st.booleans())


@SETTINGS
@given(payloads=st.lists(payload_st, min_size=1, max_size=4))
def test_unpack_payload_matches_model(spark, payloads):
    import base64
    from shiftwise.operators import unpack_payload
    data, expected = [], []
    for pid, (schema, lines, header, eol, trailing) in enumerate(payloads):
        body = ([schema] if header else []) + lines
        text = eol.join(body) + (eol if trailing else "")
        data.append((pid, schema, base64.b64encode(text.encode()).decode()))
        expected += [(pid, *r) for r in _parse_model(schema, text)]
    df = spark.createDataFrame(data, "pid int, s string, p string")
    got = rows(unpack_payload(df, "s", "p", keep=["pid"]), "pid", "schema", "line_no", "values")
    assert got == sorted(expected, key=lambda t: (t[0], t[2]))


@SETTINGS
@given(data=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)),
                               st.integers(0, 5)), max_size=15))
def test_latest_per_key_matches_model(spark, data):
    from shiftwise.operators import latest_per_key
    df = spark.createDataFrame([(k, d, t, i) for i, (k, d, t) in enumerate(data)],
                               "k int, d int, t int, i int")
    out = latest_per_key(df, ["k"], ["d"], tie_break=["t", "i"])
    best = {}
    for i, (k, d, t) in enumerate(data):   # descending, NULLs last
        key = (d is not None, d if d is not None else 0, t, i)
        if k not in best or key > best[k][0]:
            best[k] = (key, i)
    assert rows(out, "k", "i") == sorted((k, v[1]) for k, v in best.items())
