"""Writers: load-type-driven table writes, clustered layout, safe self-replace,
JDBC overwrite."""

from __future__ import annotations

import os
import uuid
from typing import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.session import ensure_checkpoint_dir, file_system

LOAD_MODES = ("overwrite", "append", "ignore", "error", "errorifexists")


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet",
                source_system: str | None = None, partition_by: Sequence[str] | None = None,
                staged: bool = False, options: dict | None = None,
                bucket_by: tuple[int, Sequence[str]] | None = None,
                dynamic_partitions: bool = False) -> None:
    """Write ``df`` to a catalog table or a path with the job's load type.

    ``source_system`` tags every row with a ``source_system`` column.
    ``staged=True`` is for overwrites by jobs that read ``target``: the result
    is written in full next to the target, on the same file system or in the
    same catalog, and only then takes its place; the old state is deleted last.
    If the write fails the target is untouched and the staging copy is removed.
    ``bucket_by=(n, keys)`` (catalog tables only) stores the table hashed and
    sorted on ``keys`` in ``n`` buckets: later joins and aggregations on those
    keys read it without shuffling it (e.g. every sync run against it).
    ``dynamic_partitions=True`` with ``partition_by`` makes an overwrite
    replace only the partitions present in ``df`` (an incremental load of a
    few days rewrites those days, not the whole table). With ``staged=True`` (a
    path) those partitions are written beside the target and then swapped in one
    by one (``swap_partitions``); no other file is touched.
    """
    mode = (mode or "overwrite").lower()
    if mode not in LOAD_MODES:
        raise ValueError(f"load type must be one of {LOAD_MODES}")
    if source_system is not None:
        df = df.withColumn("source_system", F.lit(source_system))
    if staged and mode != "overwrite":
        raise ValueError("staged writes replace the target: use load type overwrite")
    if staged and dynamic_partitions and not _is_path(target):
        raise ValueError("staged partitions need a path: a catalog keeps its own list of partitions")
    swap_parts = staged and dynamic_partitions
    spark, final = df.sparkSession, target
    if staged:
        target = _beside(target, "stage")
    w = df.write.format(fmt).mode("error" if staged else mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic_partitions and not staged:
            w = w.option("partitionOverwriteMode", "dynamic")
    elif dynamic_partitions:
        raise ValueError("dynamic_partitions needs partition_by")
    if bucket_by:
        if _is_path(target):
            raise ValueError("bucketing needs a catalog table, not a path")
        n, keys = bucket_by
        w = w.bucketBy(int(n), *keys).sortBy(*keys)
    try:
        if _is_path(target):
            w.save(target)
        else:
            w.saveAsTable(target)
    except BaseException:
        if staged:
            _drop(spark, target)
        raise
    if swap_parts:
        swap_partitions(spark, target, final, len(list(partition_by)))
    elif staged:
        _swap(spark, target, final)


def _beside(target: str, role: str) -> str:
    """A new name next to ``target`` (hidden from readers of its parent path)."""
    tag = f"{role}_{uuid.uuid4().hex[:8]}"
    if _is_path(target):
        parent, _, name = target.rstrip("/").rpartition("/")
        return f"{parent}/_{name}_{tag}"
    return f"{target}_{tag}"


def _exists(spark: SparkSession, target: str) -> bool:
    if _is_path(target):
        fs, cls = file_system(spark, target)
        return fs.exists(cls(target))
    return spark.catalog.tableExists(target)


def _drop(spark: SparkSession, target: str) -> None:
    if _is_path(target):
        fs, cls = file_system(spark, target)
        fs.delete(cls(target), True)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {target}")


def _rename(spark: SparkSession, source: str, target: str) -> None:
    if _is_path(target):
        fs, cls = file_system(spark, target)
        if not fs.rename(cls(source), cls(target)):
            raise OSError(f"cannot rename {source} to {target}")
    else:
        spark.sql(f"ALTER TABLE {source} RENAME TO {target}")


def _swap(spark: SparkSession, stage: str, target: str) -> None:
    """Put the finished ``stage`` in the place of ``target``: the old state is
    renamed away, the new one renamed in, the old one deleted; if the second
    rename fails the first is undone."""
    old = _beside(target, "old") if _exists(spark, target) else None
    if old:
        _rename(spark, target, old)
    try:
        _rename(spark, stage, target)
    except BaseException:
        if old:
            _rename(spark, old, target)
        _drop(spark, stage)
        raise
    if old:
        _drop(spark, old)
    if _is_path(target):
        spark.catalog.refreshByPath(target)
    else:
        spark.catalog.refreshTable(target)


# --- partitions ------------------------------------------------------------------------------

_DROP = "_drop"  # in a staging folder: partitions that the swap removes


def _folders(fs, cls, path: str) -> list[str]:
    return sorted(f.getPath().getName() for f in fs.listStatus(cls(path))
                  if f.isDirectory() and not f.getPath().getName().startswith(("_", "."))) \
        if fs.exists(cls(path)) else []


def list_partitions(spark: SparkSession, target: str, depth: int = 1) -> list[str]:
    """The partition folders below a path, ``depth`` levels deep
    (``["day=2024-01-01", ...]``)."""
    fs, cls = file_system(spark, target)
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{name}".lstrip("/") for p in found for name in _folders(fs, cls, f"{target}/{p}".rstrip("/"))
                 if "=" in name]
    return found


def partition_values(folder: str) -> tuple[str | None, ...]:
    """Values of a partition folder as text (NULL for the default partition)."""
    out = []
    for part in folder.split("/"):
        value = part.partition("=")[2]
        out.append(None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value))
    return tuple(out)


def swap_partitions(spark: SparkSession, stage: str, target: str, depth: int = 1,
                    drop: Sequence[str] = ()) -> list[str]:
    """Put the partitions of the finished ``stage`` in the place of the target's
    partitions of the same name, and remove the ``drop`` ones; returns all of
    them. Other partitions are not touched.

    Each partition is two renames: its old files move to a folder beside the
    target, the new ones move in. If a rename fails, what was swapped is swapped
    back. If the program ends half-way, ``resume_swaps`` finishes: the list of
    dropped partitions is stored in the stage before the first rename, and a
    partition still in the stage is one not yet swapped."""
    stage, target = stage.rstrip("/"), target.rstrip("/")
    fs, cls = file_system(spark, target)
    if drop:
        stream = fs.create(cls(f"{stage}/{_DROP}"), True)
        stream.write(bytearray("\n".join(drop).encode()))
        stream.close()
    return _finish_swap(spark, stage, target, depth, list(drop), f"{stage}_old")


def _finish_swap(spark, stage, target, depth, drop, old) -> list[str]:
    fs, cls = file_system(spark, target)
    new = list_partitions(spark, stage, depth)
    done: list[tuple[str, str]] = []

    def move(source: str, to: str) -> None:
        fs.mkdirs(cls(to).getParent())
        if not fs.rename(cls(source), cls(to)):
            raise OSError(f"cannot rename {source} to {to}")
        done.append((source, to))

    try:
        for part in [*drop, *new]:
            if fs.exists(cls(f"{target}/{part}")):
                move(f"{target}/{part}", f"{old}/{part}")
            if part in new:
                move(f"{stage}/{part}", f"{target}/{part}")
    except BaseException:
        for source, to in reversed(done):
            fs.rename(cls(to), cls(source))
        fs.delete(cls(old), True)
        raise
    fs.delete(cls(old), True)
    fs.delete(cls(stage), True)
    spark.catalog.refreshByPath(target)
    return [*drop, *new]


def resume_swaps(spark: SparkSession, target: str, depth: int = 1) -> int:
    """Finish the partition swaps of ``target`` that a stopped program left:
    complete stages (with a success marker) are swapped in, others removed.
    Returns how many were finished. Not to be called while a job writes the target."""
    target = target.rstrip("/")
    parent, _, name = target.rpartition("/")
    fs, cls = file_system(spark, target)
    finished = 0
    for status in fs.listStatus(cls(parent)):
        folder = status.getPath().getName()
        if not folder.startswith(f"_{name}_stage_") or folder.endswith("_old"):
            continue
        stage = f"{parent}/{folder}"
        if fs.exists(cls(f"{stage}/_SUCCESS")):
            drop = []
            if fs.exists(cls(f"{stage}/{_DROP}")):
                stream = fs.open(cls(f"{stage}/{_DROP}"))
                text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
                stream.close()
                drop = text.split("\n")
            _finish_swap(spark, stage, target, depth, drop, f"{stage}_old")
            finished += 1
        else:
            fs.delete(cls(stage), True)
    return finished


def write_clustered(df: DataFrame, target: str, cols: Sequence[str], mode: str = "overwrite",
                    fmt: str = "parquet", num_partitions: int | None = None) -> None:
    """Write with rows clustered by ``cols``: range-partition on them and sort
    within each partition, so every output file covers a narrow, sorted key
    range (min/max statistics let later scans skip files).

    A hash of the whole row, then the input partition id, are the last range
    keys: rows sharing one hot key value - even exact copies of one row - are
    spread over several partitions instead of one. Both are deterministic (a
    partition's rows do not change on recompute), so a retried task rebuilds
    exactly the same partitions."""
    cols = list(cols)
    order = [*cols, F.xxhash64(*df.columns).alias("__row_hash"),
             F.spark_partition_id().alias("__input_part")]
    parts = df.repartitionByRange(num_partitions, *order) if num_partitions \
        else df.repartitionByRange(*order)
    w = parts.sortWithinPartitions(*cols).write.format(fmt).mode(mode)
    if _is_path(target):
        w.save(target)
    else:
        w.saveAsTable(target)


# --- several columns at once -----------------------------------------------------------------

def _as_numbers(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Numbers in the order of the columns. Strings: what follows the prefix that all
    of a column's values share (that of the least and the greatest), seven bytes of it."""
    kinds = dict(df.dtypes)
    texts = [c for c in cols if kinds[c] == "string"]
    ends = df.agg(*[f(c) for c in texts for f in (F.min, F.max)]).first() if texts else ()
    shared = {c: len(os.path.commonprefix([lo or "", hi or ""]))
              for c, lo, hi in zip(texts, ends[::2], ends[1::2])}
    out = []
    for name in cols:
        c = F.col(name)
        if kinds[name] in ("date", "timestamp", "timestamp_ntz"):
            c = F.unix_micros(c.cast("timestamp"))
        elif kinds[name] == "string":
            rest = F.substring(F.encode(F.substring(c, shared[name] + 1, 7), "UTF-8"), 1, 7)
            c = F.conv(F.rpad(F.hex(rest), 14, "0"), 16, 10).cast("bigint")
        else:
            c = c.cast("int" if kinds[name] == "boolean" else "double")
        out.append(c)
    return out


def interleaved_key(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """A sort key under which rows that are near in all of ``cols`` are near: each
    column's rank among 2 ** ``bits`` equally full slices, the bits of all ranks
    interleaved, most significant first. NULL ranks first. The slices are cut by
    quantile sketches: one aggregation over the columns, run now, of which 2 **
    ``bits`` - 1 numbers a column reach the driver."""
    cols = list(cols)
    if not cols or bits < 1 or bits * len(cols) > 62:
        raise ValueError("give columns, and bits so that all ranks fit in 62 bits")
    at = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = _as_numbers(df, cols)
    found = df.agg(*[F.approx_percentile(n, at).alias(f"q{i}") for i, n in enumerate(numbers)]).first()
    key = F.lit(0).cast("bigint")
    for place, number in enumerate(numbers):
        cuts = F.array(*[F.lit(q) for q in sorted(set(found[place] or []))])
        below = F.size(F.filter(cuts, lambda q: q <= number)) if found[place] else F.lit(0)
        rank = F.when(number.isNull(), F.lit(0)).otherwise(below).cast("bigint")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(1)
            key = key.bitwiseOR(F.shiftleft(bit, b * len(cols) + len(cols) - 1 - place))
    return key


def write_interleaved(df: DataFrame, target: str, cols: Sequence[str], mode: str = "overwrite",
                      fmt: str = "parquet", num_partitions: int | None = None, bits: int = 6) -> None:
    """Write with rows clustered by all of ``cols`` at once: files are narrow in each
    of them, so a scan that filters on any one can skip files by their minima and
    maxima. (``write_clustered`` orders by the first column; its files are wide in
    the others.) As there, the row's hash and its input partition spread rows of
    one key over several files, deterministically."""
    columns = df.columns
    keyed = df.withColumn("__key", interleaved_key(df, cols, bits))
    order = [F.col("__key"), F.xxhash64(*columns).alias("__row_hash"), F.spark_partition_id().alias("__input_part")]
    parts = keyed.repartitionByRange(num_partitions, *order) if num_partitions else keyed.repartitionByRange(*order)
    w = parts.sortWithinPartitions("__key", *cols).drop("__key").write.format(fmt).mode(mode)
    if _is_path(target):
        w.save(target)
    else:
        w.saveAsTable(target)


def write_jdbc(df: DataFrame, options: dict, mode: str = "overwrite", truncate: bool = True,
               batch_size: int = 10_000, num_partitions: int | None = None,
               staged: bool = False) -> None:
    """JDBC write. ``truncate`` keeps the table definition on overwrite;
    ``num_partitions`` caps concurrent connections; ``staged=True`` checkpoints
    first so a job that reads the same table is not emptied by its own
    overwrite. The overwrite itself is not atomic: a database that must never
    be seen half-written needs a staging table and a rename on its side."""
    if mode not in LOAD_MODES:
        raise ValueError(f"load type must be one of {LOAD_MODES}")
    opts = jdbc_write_options(options, mode, truncate, batch_size, num_partitions)
    if staged:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    df.write.format("jdbc").options(**opts).mode(mode).save()


def jdbc_write_options(options: dict, mode: str = "overwrite", truncate: bool = True,
                       batch_size: int = 10_000, num_partitions: int | None = None) -> dict:
    """Writer options for a JDBC sink: batched inserts, TRUNCATE instead of
    DROP on overwrite (keeps indexes and grants), and a cap on concurrent
    connections. Options already given win."""
    opts = {k: str(v) for k, v in dict(options).items()}
    opts.setdefault("batchsize", str(int(batch_size)))
    if truncate and mode == "overwrite":
        opts.setdefault("truncate", "true")
    if num_partitions:
        opts.setdefault("numPartitions", str(int(num_partitions)))
    return opts
