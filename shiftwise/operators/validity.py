"""Temporal-validity join: facts joined to the dimension version whose
half-open interval ``[start, end)`` contains the fact time.

Strategies (all give the same rows):

* ``broadcast`` - hash join on the keys with the interval as a residual; the
  version side is shipped to every task. Only chosen by ``auto`` when the
  tables that feed the version side hold at most ``broadcast_max_bytes`` (known
  to the planner, no job runs).
* ``binned``    - both sides get a day-bin column; versions are exploded over
  the days they cover (clipped to the report range) and the join runs on
  ``keys + bin`` with the exact interval as a residual. A hot key is split
  into one join group per day instead of one huge group, and the shuffle is
  bounded by the report range, not by open-ended validity intervals.
* ``adaptive``  - as ``binned``, but a key with very many facts gets bins of its own
  width, taken from a counted histogram of its facts (``hot_bins``), so a key that
  is hot within one day is split too; what falls within a few seconds is salted.
  Other keys keep day bins.
* ``merge``     - one ordered pass, without bins or an interval test: version
  starts and ends are the points at which the set of open versions of a key
  changes. Each point carries the versions open from it on; points and facts are
  united, sorted by time within the key, and every fact takes the versions of the
  last point before it. Facts are shuffled once. A version is repeated only for
  the points of other versions of its key that it spans, not for the days it
  covers: an open-ended version without overlap is one row. Hot keys are split at
  the bin limits of ``adaptive``, which become points as well.
* ``shuffle``   - plain equi join with residual; Catalyst/AQE pick the strategy.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.operators._checks import BROADCAST_MAX_BYTES, input_bytes, require_keys
from shiftwise.session import scratch_path

_BIN = "__vbin"
DAY = 86_400  # seconds
#: Facts of one key that one join group may hold before the key is split.
HOT_ROWS = 1_000_000
#: All hot keys together are split into at most about four times so many bins.
MAX_BINS = 100_000
HALVINGS = 20


def _epoch_day(c: Column) -> Column:
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date"))


def validity_join(facts: DataFrame, versions: DataFrame, keys: Sequence[str], ts: str,
                  start: str = "RecordStartDateInclusive",
                  end: str = "RecordEndDateNonInclusive",
                  strategy: str = "auto",
                  broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
                  bin_days: int = 1,
                  clip: tuple | None = None,
                  hot_rows: int = HOT_ROWS,
                  hot: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Inner join ``facts`` to ``versions`` on ``keys`` and ``start <= ts < end``.

    Output: every fact column, then every version column except the keys.
    A version with a NULL start or end never matches (as in SQL). Overlapping
    versions each produce a row. ``clip=(lo, hi)`` keeps only facts with
    ``lo <= ts <= hi``, whatever the strategy; versions that cannot meet such a
    fact are left out early, and the binned strategy emits bins inside the
    range only. Without ``clip`` the binned strategy scans the facts once more
    for their span, so give a range where there is one. ``hot_rows`` is the number
    of facts of one key beyond which ``adaptive`` and ``merge`` split it. They count
    them inside the plan, in which the small result is used several times;
    ``hot=stored_hot_bins(...)`` counts them once, in a job of its own.
    """
    keys = require_keys(keys)
    fact_cols = facts.columns
    version_extra = [c for c in versions.columns if c not in keys]
    clash = [c for c in version_extra if c in fact_cols]
    if clash:
        raise ValueError(f"version columns clash with fact columns: {clash}")

    versions = versions.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    if clip is not None:
        lo, hi = F.lit(clip[0]), F.lit(clip[1])
        facts = facts.filter(F.col(ts).between(lo, hi))
        versions = versions.filter((F.col(start) <= hi) & (F.col(end) > lo))

    if strategy == "auto":
        strategy = "broadcast" if input_bytes(versions) <= broadcast_max_bytes else "binned"

    if strategy == "adaptive":
        return _adaptive(facts, versions, keys, ts, start, end, version_extra,
                         hot or hot_bins(facts, keys, ts, hot_rows))
    if strategy == "merge":
        return _merge(facts, versions, keys, ts, start, end, version_extra,
                      hot or hot_bins(facts, keys, ts, hot_rows))
    if strategy == "binned":
        return _binned(facts, versions, keys, ts, start, end, bin_days, clip, version_extra)

    f, v = facts.alias("__f"), versions.alias("__v")
    if strategy == "broadcast":
        v = F.broadcast(v)
    elif strategy != "shuffle":
        raise ValueError(f"unknown strategy {strategy!r}")
    cond = _key_cond(keys) & (F.col(f"__f.{ts}") >= F.col(f"__v.{start}")) \
        & (F.col(f"__f.{ts}") < F.col(f"__v.{end}"))
    return f.join(v, cond, "inner").select(
        *[F.col(f"__f.{c}") for c in fact_cols], *[F.col(f"__v.{c}") for c in version_extra])


def _key_cond(keys: Sequence[str], left: str = "__f", right: str = "__v") -> Column:
    cond = None
    for k in keys:
        c = F.col(f"{left}.{k}") == F.col(f"{right}.{k}")
        cond = c if cond is None else cond & c
    return cond


def _binned(facts, versions, keys, ts, start, end, bin_days, clip, version_extra):
    lo_day = _epoch_day(F.col(start))
    hi_day = _epoch_day(F.col(end))
    if clip is not None:
        clip_lo, clip_hi = clip
        lo_day = F.greatest(lo_day, _epoch_day(F.lit(clip_lo).cast("timestamp")))
        hi_day = F.least(hi_day, _epoch_day(F.lit(clip_hi).cast("timestamp")))
    else:
        # No report range given: bound the explosion by the facts' own span,
        # computed as scalar subqueries (distributed aggregate, no collect).
        span = facts.select(F.min(_epoch_day(F.col(ts))).alias("lo"),
                            F.max(_epoch_day(F.col(ts))).alias("hi"))
        lo_day = F.greatest(lo_day, span.select("lo").scalar())
        hi_day = F.least(hi_day, span.select("hi").scalar())
    width = F.lit(int(bin_days))
    vb = (versions
          .withColumn("__lo", F.floor(lo_day / width).cast("int"))
          .withColumn("__hi", F.floor(hi_day / width).cast("int"))
          .filter(F.col("__lo") <= F.col("__hi"))
          .withColumn(_BIN, F.explode(F.sequence(F.col("__lo"), F.col("__hi"))))
          .drop("__lo", "__hi"))
    fb = facts.withColumn(_BIN, F.floor(_epoch_day(F.col(ts)) / width).cast("int"))
    f, v = fb.alias("__f"), vb.alias("__v")
    cond = _key_cond(list(keys) + [_BIN]) & (F.col(f"__f.{ts}") >= F.col(f"__v.{start}")) \
        & (F.col(f"__f.{ts}") < F.col(f"__v.{end}"))
    return f.join(v, cond, "inner").select(
        *[F.col(f"__f.{c}") for c in facts.columns], *[F.col(f"__v.{c}") for c in version_extra])


# --- hot keys -----------------------------------------------------------------------------

def _seconds(c: Column) -> Column:
    """Whole seconds since 1970 of a time column, rounded down."""
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000)).cast("long")


def hot_bins(facts: DataFrame, keys: Sequence[str], ts: str,
             hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """How to split the keys with very many facts: two small frames.

    * (keys, ``lo``, ``width``, ``bins``): the key's facts begin at second ``lo`` and
      are cut into ``bins`` bins of ``width`` seconds. The width is the widest of the
      key's span, its half, its quarter, .. for which no bin holds more than
      ``hot_rows`` facts; a key gets at most about 4 n / ``hot_rows`` bins.
    * (keys, ``bin``, ``salts``): bins that still hold more (many facts within a few
      seconds) and into how many parts their facts are dealt.

    A key is hot when it has more than ``hot_rows`` facts and more than one
    ``MAX_BINS``-th of all of them, so both frames stay below a few times
    ``MAX_BINS`` rows whatever the input, and may be broadcast. Facts are counted
    per key first (combined map-side); those of hot keys are then counted by second,
    and all widths are tried on that histogram."""
    keys = list(keys)
    timed = facts.filter(F.col(ts).isNotNull()).select(*keys, _seconds(F.col(ts)).alias("__s"))
    counts = timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__s").alias("lo"),
                                      F.max("__s").alias("__hi"))
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("t")).select("t").scalar()
    most = F.greatest(F.lit(int(hot_rows)), F.floor(total / F.lit(MAX_BINS)))
    hot = counts.filter(F.col("__n") > most).select(
        *keys, "lo", (F.col("__hi") - F.col("lo") + 1).alias("__span"), most.alias("__most"),
        F.least(F.lit(HALVINGS), F.ceil(F.log2(4 * F.col("__n") / most))).cast("int").alias("__deepest"))
    histogram = timed.join(F.broadcast(hot), keys).groupBy(*keys, "lo", "__span", "__most", "__deepest", "__s").agg(
        F.count(F.lit(1)).alias("__n"))
    tried = F.explode(F.sequence(F.lit(0), F.col("__deepest"))).alias("__half")
    width = F.greatest(F.lit(1), F.ceil(F.col("__span") / F.pow(F.lit(2), F.col("__half")))).cast("long")
    place = F.floor((F.col("__s") - F.col("lo")) / F.col("width")).cast("long")
    bins = (histogram.select("*", tried).withColumn("width", width)
            .groupBy(*keys, "lo", "__span", "__most", "__half", "width", place.alias("bin"))
            .agg(F.sum("__n").alias("__n")))
    by_width = bins.groupBy(*keys, "lo", "__span", "__most", "__half", "width").agg(
        F.max("__n").alias("__fullest"),
        F.collect_list(F.when(F.col("__n") > F.col("__most"), F.struct(
            "bin", F.ceil(F.col("__n") / F.col("__most")).cast("int").alias("salts")))).alias("__full"))
    # The widest that fits, else the narrowest.
    best = F.min_by(F.struct("width", "__full"), F.when(F.col("__fullest") <= F.col("__most"), F.col("__half"))
                    .otherwise(F.lit(2 * HALVINGS) - F.col("__half")))
    chosen = by_width.groupBy(*keys, "lo", "__span").agg(best.alias("__c"))
    split = chosen.select(*keys, "lo", F.col("__c.width").alias("width"),
                          F.ceil(F.col("__span") / F.col("__c.width")).cast("long").alias("bins"))
    return split, chosen.select(*keys, F.inline("__c.__full"))


def stored_hot_bins(facts: DataFrame, keys: Sequence[str], ts: str,
                    hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """``hot_bins``, counted now and stored in the shared scratch folder."""
    out = []
    for name, frame in zip(("hot-keys", "hot-bins"), hot_bins(facts, keys, ts, hot_rows)):
        path = scratch_path(facts.sparkSession, name)
        frame.write.parquet(path)
        out.append(facts.sparkSession.read.schema(frame.schema).parquet(path))
    return out[0], out[1]


def _placed(df: DataFrame, split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``__lo``, ``__w``, ``__bins`` of its key (NULL: not hot)."""
    side = split.withColumnsRenamed({"lo": "__lo", "width": "__w", "bins": "__bins"})
    return df.join(F.broadcast(side), list(keys), "left")


def _bin_at(second: Column, otherwise: Column) -> Column:
    """The bin of a hot key that holds a second (the first or last, beyond them)."""
    at = F.floor((second - F.col("__lo")) / F.col("__w")).cast("long")
    return F.when(F.col("__w").isNull(), otherwise).otherwise(
        F.greatest(F.lit(0), F.least(at, F.col("__bins") - 1))).cast("long")


def _salted(df: DataFrame, full: DataFrame, keys: Sequence[str], by: Sequence[str] | None) -> DataFrame:
    """``df`` (with ``__vbin``) and its ``__salt``: dealt by the content of columns
    ``by``, or with ``None`` one copy of the row for each part."""
    side = full.withColumnsRenamed({"bin": _BIN, "salts": "__salts"})
    df = df.join(F.broadcast(side), [*keys, _BIN], "left")
    salts = F.coalesce("__salts", F.lit(1))
    if by is None:
        salt = F.explode(F.sequence(F.lit(0), salts - 1))
    else:
        salt = F.when(salts > 1, F.pmod(F.xxhash64(*by), salts)).otherwise(F.lit(0)).cast("int")
    return df.withColumn("__salt", salt).drop("__salts")


def _hashable(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]


def _adaptive(facts, versions, keys, ts, start, end, version_extra, hot):
    split, full = hot
    day = lambda s: F.floor(s / F.lit(DAY)).cast("long")
    fb = _placed(facts, split, keys).withColumn(_BIN, _bin_at(_seconds(F.col(ts)), day(_seconds(F.col(ts)))))
    fb = _salted(fb, full, keys, _hashable(facts))
    span = facts.select(F.min(_seconds(F.col(ts))).alias("lo"), F.max(_seconds(F.col(ts))).alias("hi"))
    lo, hi = _seconds(F.col(start)), _seconds(F.col(end))
    inside = F.col("__w").isNull() | ((hi >= F.col("__lo")) & (lo < F.col("__lo") + F.col("__w") * F.col("__bins")))
    vb = (_placed(versions.filter(F.col(start) < F.col(end)), split, keys).filter(inside)
          .withColumn("__from", _bin_at(lo, day(F.greatest(lo, span.select("lo").scalar()))))
          .withColumn("__to", _bin_at(hi, day(F.least(hi, span.select("hi").scalar()))))
          .filter(F.col("__from") <= F.col("__to"))
          .withColumn(_BIN, F.explode(F.sequence("__from", "__to"))))
    vb = _salted(vb, full, keys, None)
    f, v = fb.alias("__f"), vb.alias("__v")
    cond = _key_cond([*keys, _BIN, "__salt"]) & (F.col(f"__f.{ts}") >= F.col(f"__v.{start}")) \
        & (F.col(f"__f.{ts}") < F.col(f"__v.{end}"))
    return f.join(v, cond, "inner").select(
        *[F.col(f"__f.{c}") for c in facts.columns], *[F.col(f"__v.{c}") for c in version_extra])


# --- ordered pass ---------------------------------------------------------------------------

def _merge(facts, versions, keys, ts, start, end, version_extra, hot):
    kinds = dict(facts.dtypes)[ts], dict(versions.dtypes)[start], dict(versions.dtypes)[end]
    kind = "timestamp" if "timestamp" in kinds or "string" in kinds else "timestamp_ntz"
    t = lambda c: F.col(c).cast(kind)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    split, full = hot
    vs = versions.filter(known & (F.col(start) < F.col(end))).select(
        *keys, t(start).alias("__s"), t(end).alias("__e"), F.struct(*version_extra).alias("__v"))

    # Points: all version limits of a key, and the bin limits of a hot key.
    bins = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") - 1)).alias("__b")
    cuts = split.select(*keys, "lo", "width", bins).select(
        *keys, F.timestamp_seconds(F.col("lo") + F.col("__b") * F.col("width")).cast(kind).alias("__t"))
    limits = vs.select(*keys, F.explode(F.array("__s", "__e")).alias("__t"))
    points = limits.unionByName(cuts).distinct()
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("__t"))
    points = points.withColumn("__p", number)

    # The versions open from each point on: a version spans the points from its start
    # to the one before its end.
    spans = (vs.join(points.withColumnsRenamed({"__t": "__s", "__p": "__from"}), [*keys, "__s"])
             .join(points.withColumnsRenamed({"__t": "__e", "__p": "__to"}), [*keys, "__e"])
             .withColumn("__p", F.explode(F.sequence("__from", F.col("__to") - 1))))
    open_at = spans.groupBy(*keys, "__p").agg(F.collect_list("__v").alias("__open"))
    versions_type = open_at.schema["__open"].dataType
    none = F.array().cast(versions_type)
    marks = points.join(open_at, [*keys, "__p"], "left").select(
        *keys, F.col("__t"), F.coalesce("__open", none).alias("__open"))

    # One ordered pass: every fact takes the open versions of the last point before it.
    nowhere = F.lit(0).cast("long")
    left = _placed(facts.filter(known & F.col(ts).isNotNull()), split, keys).withColumn("__t", t(ts))
    left = _salted(left.withColumn(_BIN, _bin_at(_seconds(F.col("__t")), nowhere)), full, keys, _hashable(facts))
    left = left.select(*keys, "__t", _BIN, "__salt", F.lit(1).alias("__kind"),
                       F.lit(None).cast(versions_type).alias("__open"),
                       F.struct(*[F.col(c) for c in facts.columns]).alias("__fact"))
    right = _placed(marks, split, keys).withColumn(_BIN, _bin_at(_seconds(F.col("__t")), nowhere))
    right = _salted(right, full, keys, None).select(
        *keys, "__t", _BIN, "__salt", F.lit(0).alias("__kind"), "__open",
        F.lit(None).cast(left.schema["__fact"].dataType).alias("__fact"))
    order = Window.partitionBy(*keys, _BIN, "__salt").orderBy("__t", "__kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = (left.unionByName(right).withColumn("__now", F.last("__open", ignorenulls=True).over(order))
           .filter((F.col("__kind") == 1) & (F.size("__now") > 0)))
    found = met.select("__fact", F.explode("__now").alias("__v"))
    return found.select(*[F.col("__fact")[c].alias(c) for c in facts.columns],
                        *[F.col("__v")[c].alias(c) for c in version_extra])
