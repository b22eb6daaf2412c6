"""Sync jobs: read a target table, apply a staging snapshot, write it back.

The new state depends on the old one, so the write is staged: a catalog table
or path is written in full beside the target and then takes its place; a JDBC
target is checkpointed to the shared checkpoint folder before the overwrite.

``sync_partitions`` rewrites only what a stage touches of a target partitioned by
a function of its keys (for facts keyed by time: the day). Rows that match have
the same partition, so partitions are synchronised independently:

1. Partitions of the stage are listed (a distinct of its partition values), those
   of the target read from its folder names.
2. Fact policies delete rows without a match, so target partitions the stage does
   not have are dropped unread. Under ``scope="stage"`` (an incremental load: the
   stage is complete for its own partitions and says nothing of others) they are
   out of scope, for every policy.
3. The others are joined once to find the partitions in which any row changes; a
   partition all of whose rows stay as they are keeps its files.
4. Changed partitions alone are read and joined again, written beside the target
   and swapped in one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shiftwise.operators.sync import sync, sync_changes
from shiftwise.session import file_system
from shiftwise.sources.readers import read_source
from shiftwise.sources.sinks import (
    _beside,
    _drop,
    list_partitions,
    partition_values,
    swap_partitions,
    write_jdbc,
    write_table,
)


def sync_table(spark: SparkSession, target: str, stage: DataFrame, keys: Sequence[str],
               values: Sequence[str], policy: str, now, kind: str = "table",
               fmt: str = "parquet", buckets: int | None = None,
               stage_names: Mapping[str, str] | None = None,
               jdbc: Mapping[str, str] | None = None, **options) -> DataFrame:
    """Apply ``stage`` to the table (``kind="table"``), path, or JDBC table
    (``kind="jdbc"``, connection and read options in ``jdbc``) named ``target``
    and write the result back in place. With ``buckets`` a catalog table is
    stored bucketed on ``keys``, so the next run's join shuffles only the
    stage. Returns the new state as read back from ``target``."""
    def read() -> DataFrame:
        if kind == "jdbc":
            return read_source(spark, "jdbc", **jdbc_target(target, jdbc))
        return read_source(spark, kind, target)

    new_state = sync(read(), stage, keys, values, policy, now, stage_names=stage_names,
                     **options)
    if kind == "jdbc":
        write_jdbc(new_state, jdbc_target(target, jdbc, write=True), staged=True)
    else:
        write_table(new_state, target, mode="overwrite", fmt=fmt, staged=True,
                    bucket_by=(buckets, list(keys)) if buckets else None)
    return read()


def jdbc_target(target: str, jdbc: Mapping[str, str] | None, write: bool = False) -> dict:
    """Connection options with ``target`` as the table; read-only options
    (partitioning, fetch size) are left out for the write."""
    if not jdbc or "url" not in jdbc:
        raise ValueError('kind="jdbc" needs jdbc={"url": ...}')
    read_only = {"partition_column", "lower_bound", "upper_bound", "num_partitions", "fetch_size",
                 "partitionColumn", "lowerBound", "upperBound", "numPartitions", "fetchsize"}
    out = {k: v for k, v in jdbc.items() if not (write and k in read_only)}
    return {**out, "dbtable": target}


# --- partition by partition ---------------------------------------------------------------

Values = tuple[str | None, ...]


@dataclass(frozen=True)
class PartitionReport:
    """What a run did: partitions rewritten (new ones included), dropped, and left."""
    rewritten: list[Values]
    dropped: list[Values]
    kept: list[Values]


def write_partitioned(df: DataFrame, target: str, partition: Mapping[str, str], fmt: str = "parquet") -> None:
    """Write a target for ``sync_partitions``: ``partition`` maps each partition
    column to a SQL expression over key columns. Values are stored as text."""
    write_table(_with_partition(df, partition), target, fmt=fmt, partition_by=list(partition))


def read_partitioned(spark: SparkSession, target: str, columns: StructType, partition: Mapping[str, str],
                     fmt: str = "parquet") -> DataFrame:
    """The target with its partition columns as text (folder names are not read as
    numbers or dates)."""
    schema = StructType(list(columns.fields))
    for name in partition:
        schema = schema.add(name, "string")
    return spark.read.format(fmt).schema(schema).load(target)


def sync_partitions(spark: SparkSession, target: str, stage: DataFrame, keys: Sequence[str],
                    values: Sequence[str], policy: str, now, columns: StructType, partition: Mapping[str, str],
                    scope: str = "all", fmt: str = "parquet", stage_names: Mapping[str, str] | None = None,
                    **options) -> PartitionReport:
    """Apply ``stage`` to the path ``target`` (as ``write_partitioned`` stores it),
    rewriting changed partitions only. ``columns`` are the target's columns
    without the partition ones. With ``scope="all"`` the new state is that of
    ``sync`` over the whole table; with ``scope="stage"`` that of ``sync`` over the
    stage's partitions, beside all other rows as they were."""
    if scope not in ("all", "stage"):
        raise ValueError("scope must be 'all' or 'stage'")
    if options.get("keep_target_if_stage_empty") and stage.isEmpty():
        return PartitionReport([], [], _target_partitions(spark, target, len(partition)))
    names = dict(stage_names or {})
    renamed = stage.withColumnsRenamed({names[k]: k for k in keys if k in names})
    dealt = _with_partition(renamed, partition)
    staged = {tuple(r) for r in dealt.select(*partition).distinct().collect()}
    present = _target_partitions(spark, target, len(partition))
    only_target = [p for p in present if p not in staged]
    dropped = only_target if scope == "all" and policy != "dimension" else []
    join = sorted(staged, key=str) if scope == "stage" or dropped else \
        sorted(staged | set(present), key=str)

    def changes(wanted: Sequence[Values]) -> DataFrame:
        old = read_partitioned(spark, target, columns, partition, fmt).filter(_is_one_of(partition, wanted))
        old = _checked(old, partition).drop(*partition)
        new = dealt.filter(_is_one_of(partition, wanted)).drop(*partition)
        rest = {v: names[v] for v in values if v in names}
        rows = sync_changes(old, new, keys, values, policy, now, stage_names=rest, change="__change", **options)
        return _with_partition(rows, partition)

    hit = (changes(join).groupBy(*partition)
           .agg(F.bool_or(F.col("__change") != "keep").alias("touched"),
                F.count_if(F.col("__change") != "delete").alias("left")).filter("touched").collect())
    touched = [tuple(r[c] for c in partition) for r in hit]
    emptied = [tuple(r[c] for c in partition) for r in hit if r["left"] == 0]
    write = [p for p in touched if p not in set(emptied)]
    drop = [*dropped, *emptied]
    if write or drop:
        beside = _beside(target, "stage")
        rows = changes(write).filter(F.col("__change") != "delete").drop("__change")
        try:
            write_table(rows, beside, mode="error", fmt=fmt, partition_by=list(partition))
        except BaseException:
            _drop(spark, beside)
            raise
        folders = {partition_values(f): f for f in list_partitions(spark, target, len(partition))}
        swap_partitions(spark, beside, target, len(partition), [folders[p] for p in drop])
    gone = set(drop)
    return PartitionReport(sorted(write, key=str), sorted(drop, key=str),
                           [p for p in present if p not in gone and p not in set(write)])


def _target_partitions(spark: SparkSession, target: str, depth: int) -> list[Values]:
    fs, cls = file_system(spark, target)
    if not fs.exists(cls(target)):
        raise FileNotFoundError(target)
    return [partition_values(f) for f in list_partitions(spark, target, depth)]


def _with_partition(df: DataFrame, partition: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(e).cast("string") for name, e in partition.items()})


def _is_one_of(partition: Mapping[str, str], wanted: Sequence[Values]) -> Column:
    """Partition columns equal one of ``wanted``: a filter on partition columns
    alone, so a scan lists only those folders."""
    out = F.lit(False)
    for i, name in enumerate(partition):
        texts = sorted({p[i] for p in wanted if p[i] is not None})
        one = F.col(name).isin(texts) if texts else F.lit(False)
        if any(p[i] is None for p in wanted):
            one = one | F.col(name).isNull()
        out = one if i == 0 else out & one
    if len(partition) > 1:  # the combinations that occur, among those the columns allow
        row = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(n)), F.lit("")) for n in partition])
        out = out & row.isin(sorted({"/".join("" if v is None else "=" + v for v in p) for p in wanted}))
    return out


def _checked(old: DataFrame, partition: Mapping[str, str]) -> DataFrame:
    """``old``, failing the job on a row that lies in another partition than its
    keys say (its key could then be written twice)."""
    same = F.lit(True)
    for name, e in partition.items():
        same = same & F.col(name).eqNullSafe(F.expr(e).cast("string"))
    rule = F.when(~same, F.raise_error(F.lit("a target row lies in a partition its keys do not belong to")))
    return old.withColumn("__placed", rule.otherwise(F.lit(True))).filter("__placed").drop("__placed")
