"""Key-based combination of frames: enrichment joins, full outer chains,
backfill from a one-row-per-key frame, canonical unions."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.operators._checks import any_null, require_keys

SALTS = 32  # parts of a hot key in a frame with repeated keys


def enrich(base: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "inner",
           columns: Sequence[str] | None = None,
           fact_keys: Sequence[str] | None = None) -> DataFrame:
    """Join ``facts`` onto ``base`` by key equality (NULL keys never match).

    ``fact_keys`` names the matching columns in ``facts`` when they differ from
    ``keys``; ``columns`` lists the fact columns to bring along (default: all
    non-key columns). ``how`` is ``inner`` (rows without a fact are dropped)
    or ``left`` (kept, with NULL facts).
    """
    keys = require_keys(keys)
    fact_keys = list(fact_keys or keys)
    if columns is None:
        columns = [c for c in facts.columns if c not in fact_keys]
    sel = facts.select(*[F.col(fk).alias(k) for k, fk in zip(keys, fact_keys)],
                       *[F.col(c) for c in columns])
    return base.join(sel, on=keys, how=how)


def _full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left FULL JOIN right USING (keys)``; rows with a NULL key are spread
    over the partitions by a side mark and a hash of the row."""
    def spread(df: DataFrame, side: str) -> DataFrame:
        mark = F.concat(F.lit(side), F.xxhash64(*df.columns).cast("string"))
        return df.withColumn("__spread", F.when(any_null(keys), mark).otherwise(F.lit("")))
    return (spread(left, "l").join(spread(right, "r"), on=[*keys, "__spread"], how="full_outer")
            .drop("__spread"))


def _merge(uniq: Sequence[tuple[int, DataFrame]], dup: DataFrame | None,
           keys: Sequence[str]) -> DataFrame:
    """Numbered one-row-per-key frames merged by key, then met by ``dup``. A row
    with a NULL key merges only with rows of its own frame."""
    tagged = [f.withColumn("__src", F.when(any_null(keys), F.lit(i))).withColumn(f"__n{i}", F.lit(1))
              for i, f in uniq]
    if dup is not None:
        salt = F.pmod(F.xxhash64(*dup.columns), F.lit(SALTS)).cast("int")
        dup = dup.withColumn("__part", salt).withColumn("__src", F.when(any_null(keys), F.lit(-1)))
        tagged.append(dup.select(*keys, "__src", "__part"))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    once = [F.when(F.count(F.col(f"__n{i}")) > 1, F.raise_error(F.lit(f"frame {i}: repeated key {keys}")))
            .otherwise(F.max(c)).alias(c) for i, f in uniq for c in f.columns if c not in keys]
    if dup is None:
        return union.groupBy(*keys, "__src").agg(*once).drop("__src")
    merged = (union.groupBy(*keys, "__src").agg(*once, F.collect_set("__part").alias("__parts"))
              .withColumn("__part", F.explode_outer("__parts")).drop("__parts"))
    left, right = merged.alias("l"), dup.alias("r")
    cond = F.col("l.__part") == F.col("r.__part")
    for k in [*keys, "__src"]:
        cond = cond & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    own = [c for c in dup.columns if c not in (*keys, "__part", "__src")]
    return left.join(right, cond, "left").select(
        *[F.col(f"l.{c}") for c in merged.columns if c not in ("__part", "__src")],
        *[F.col(f"r.{c}") for c in own])


def full_outer_chain(frames: Sequence[DataFrame], keys: Sequence[str],
                     zero_fill: Sequence[str] | bool = (),
                     unique: Sequence[bool] | bool = False) -> DataFrame:
    """``f1 FULL JOIN f2 USING (keys) FULL JOIN f3 USING (keys) ...``.

    Keys are coalesced; a row with a NULL in any key never matches and stays a
    row of its own; duplicate keys in a frame multiply rows, as joins do.

    Frames flagged in ``unique`` have at most one row per key (e.g. they are
    the output of a ``groupBy(keys)``); a repeated key in one of them fails the
    running job. Those are merged with one ``unionByName`` + ``groupBy`` instead
    of a join per frame (when they are already hash-partitioned on the keys,
    the merge adds no shuffle), and computed once. The other frames are
    full-outer-joined among themselves into N. N's rows are dealt to ``SALTS``
    parts by their content; the merge also collects, per key, the parts in
    which N has rows. Each merged row then goes to those parts only (to one if
    there are none) and left-joins N on key and part: the rows of the full
    outer join, with a hot key of N split over the parts.
    """
    frames = list(frames)
    keys = require_keys(keys)
    if isinstance(unique, bool):
        unique = [unique] * len(frames)
    metrics = [c for f in frames for c in f.columns if c not in keys]
    dupes = {m for m in metrics if metrics.count(m) > 1}
    if dupes:
        raise ValueError(f"metric columns repeat across frames: {sorted(dupes)}")

    uniq = [(i, f) for i, (f, u) in enumerate(zip(frames, unique)) if u]
    rest = [f for f, u in zip(frames, unique) if not u]
    dup = reduce(lambda a, b: _full_join(a, b, keys), rest) if rest else None
    if not uniq:
        out = dup
    elif len(uniq) == 1 and dup is None:
        out = uniq[0][1]
    else:
        out = _merge(uniq, dup, keys)
    if zero_fill is True:
        zero_fill = metrics
    fill = set(zero_fill or ())
    return out.select(*[F.col(k) for k in keys],
                      *[F.coalesce(F.col(m), F.lit(0)).alias(m) if m in fill else F.col(m)
                        for m in metrics])


def backfill(base: DataFrame, latest: DataFrame, keys: Sequence[str],
             columns: Sequence[str] | Mapping[str, str], how: str = "inner") -> DataFrame:
    """Fill NULLs in ``columns`` of ``base`` from a one-row-per-key ``latest``.

    ``columns`` maps base column -> latest column (a list means same names).
    Base columns are replaced in place: the output has exactly base's columns.
    """
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    keys = require_keys(keys)
    sel = latest.select(*keys, *[F.col(src).alias(f"__bf_{dst}") for dst, src in columns.items()])
    j = base.join(sel, on=keys, how=how)
    return j.select(*[F.coalesce(F.col(c), F.col(f"__bf_{c}")).alias(c) if c in columns
                      else F.col(c) for c in base.columns])


def union_canonical(frames: Sequence[DataFrame], columns: Sequence[str],
                    types: Mapping[str, str] | None = None,
                    distinct: bool = False) -> DataFrame:
    """UNION ALL (or UNION when ``distinct``) by column name over a canonical
    column list, casting to ``types`` where given."""
    types = dict(types or {})

    def canon(f: DataFrame) -> DataFrame:
        return f.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                          for c in columns])

    out = reduce(lambda a, b: a.unionByName(b), [canon(f) for f in frames])
    return out.distinct() if distinct else out
