"""One entry point that turns (kind, name or path, options) into a DataFrame."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PATH_FORMATS = ("parquet", "orc", "csv", "json", "text", "delta", "avro")


def read_source(spark: SparkSession, kind: str, name_or_path: str | None = None,
                columns=None, schema=None, **options) -> DataFrame:
    """Read a catalog table (``table``), a path in a file format, or a JDBC
    relation (``jdbc``; pass ``url`` and ``dbtable``/``query`` in ``options``).

    ``columns`` projects right after the read so Catalyst prunes the scan to
    them (parquet ``ReadSchema`` / JDBC column list). ``schema`` (a
    ``StructType`` or DDL string) skips schema inference for path formats.
    """
    kind = kind.lower()
    if kind == "table":
        df = spark.read.options(**options).table(name_or_path)
    elif kind == "jdbc":
        df = read_jdbc(spark, **options)
    elif kind in PATH_FORMATS:
        reader = spark.read.format(kind).options(**options)
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.load(name_or_path)
    else:
        raise ValueError(f"unknown source kind {kind!r}")
    return df.select(*columns) if columns else df


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 partition_column: str | None = None, lower_bound=None, upper_bound=None,
                 num_partitions: int | None = None, fetch_size: int = 10_000,
                 **extra) -> dict:
    """Options for a JDBC read. With ``partition_column`` and bounds the read
    is split into ``num_partitions`` parallel range queries; without them a
    JDBC read is a single task, which does not scale."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    else:
        opts["query"] = query
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need bounds and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(int(num_partitions)))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def jdbc_date_predicates(column: str, start, end, days_per_slice: int = 1,
                         with_nulls: bool = False) -> list[str]:
    """WHERE clauses that cut ``start <= column <= end`` into slices of
    ``days_per_slice`` days - one parallel JDBC read task per slice, for tables
    keyed by time rather than by a numeric id. Bounds are full timestamps (a
    date is its midnight), slices are half-open and the last one includes
    ``end``, so together they read exactly the inclusive range.
    ``with_nulls`` adds a slice for rows with a NULL ``column``."""
    def stamp(x) -> dt.datetime:
        if isinstance(x, dt.datetime):
            return x
        if isinstance(x, dt.date):
            return dt.datetime(x.year, x.month, x.day)
        return dt.datetime.fromisoformat(str(x))

    lo, hi = stamp(start), stamp(end)
    if hi < lo or days_per_slice < 1:
        raise ValueError("need start <= end and days_per_slice >= 1")
    step, out, cur = dt.timedelta(days=days_per_slice), [], lo
    while cur + step <= hi:
        out.append(f"{column} >= '{cur}' AND {column} < '{cur + step}'")
        cur += step
    out.append(f"{column} >= '{cur}' AND {column} <= '{hi}'")
    if with_nulls:
        out.append(f"{column} IS NULL")
    return out


def equal_depth_cuts(df: DataFrame, column: str, slices: int, accuracy: int = 10_000) -> list:
    """At most ``slices - 1`` values that cut the rows of ``df`` into slices of about
    equal size on a numeric, date or timestamp column.

    ``df`` is what is known of the table to be read: a copy of its key column from
    the last run, or the reporting table it feeds. The cuts come from a quantile
    sketch (one aggregation; a quantile is off by at most 1 / ``accuracy`` of the
    rows), so only they reach the driver. A value that fills several slices
    is returned twice. Rows without a value are left out; no value at all gives no cut."""
    if slices < 1:
        raise ValueError("slices must be at least 1")
    kind = dict(df.dtypes)[column]
    numeric = F.unix_micros(F.col(column).cast("timestamp")) if kind in ("date", "timestamp", "timestamp_ntz") \
        else F.col(column)
    at = [i / slices for i in range(1, slices)]
    if not at:
        return []
    found = df.agg(F.approx_percentile(numeric, at, accuracy).alias("q")).first()["q"] or []
    cuts = sorted(c for i, c in enumerate(sorted(found)) if i < 2 or sorted(found)[i - 2] != c)
    if kind in ("date", "timestamp", "timestamp_ntz"):
        epoch = dt.datetime(1970, 1, 1)
        cuts = [epoch + dt.timedelta(microseconds=c) for c in cuts]
    return cuts


def jdbc_cut_predicates(column: str, cuts: list, with_nulls: bool = True, start=None, end=None) -> list[str]:
    """WHERE clauses, one parallel read each, for the slices between ``cuts``
    (``equal_depth_cuts``): below the first, half-open between two, from the last on;
    a value that is there twice has a slice of its own.
    ``start`` and ``end`` (inclusive) limit the whole read; cuts outside are left
    out. ``with_nulls`` adds a slice for rows without a value, so that without limits
    the slices hold every row exactly once."""
    def text(x) -> str:
        if isinstance(x, (dt.datetime, dt.date)):
            return f"'{x}'"
        if isinstance(x, bool) or not isinstance(x, (int, float, Decimal)):
            raise ValueError(f"not a cut: {x!r}")
        return str(x)

    inside = sorted(c for c in cuts if (start is None or c > start) and (end is None or c <= end))
    single = {a for a, b in zip(inside, inside[1:]) if a == b}
    lows, out = [start, *sorted(set(inside))], []
    for lo, hi in zip(lows, [*lows[1:], None]):
        if lo in single:
            out.append(f"{column} = {text(lo)}")
        parts = [] if lo is None else [f"{column} {'>' if lo in single else '>='} {text(lo)}"]
        if hi is not None:
            parts.append(f"{column} < {text(hi)}")
        elif end is not None:
            parts.append(f"{column} <= {text(end)}")
        out.append(" AND ".join(parts) or f"{column} IS NOT NULL")
    if with_nulls:
        out.append(f"{column} IS NULL")
    return out


def jdbc_read_arguments(predicates: list[str] | None = None, **options) -> dict:
    """Reader options from either spelling: keyword arguments of
    ``jdbc_options`` (``table``, ``partition_column``, ...) or Spark's own
    names. With ``predicates`` a ``query`` becomes a derived table, because
    that form of the reader takes tables only."""
    opts = dict(options)
    opts.setdefault("table", opts.pop("dbtable", None))
    spark_names = {"partitionColumn": "partition_column", "lowerBound": "lower_bound",
                   "upperBound": "upper_bound", "numPartitions": "num_partitions",
                   "fetchsize": "fetch_size"}
    for theirs, ours in spark_names.items():
        if theirs in opts:
            opts[ours] = opts.pop(theirs)
    if predicates:
        if opts.get("partition_column") is not None:
            raise ValueError("give predicates or a partition column, not both")
        if opts.get("query") is not None:
            opts["table"] = f"({opts.pop('query')}) q"
    return jdbc_options(**opts)


def read_jdbc(spark: SparkSession, predicates: list[str] | None = None, **options) -> DataFrame:
    """JDBC read (see ``jdbc_options`` for the options); with ``predicates``
    (e.g. ``jdbc_date_predicates``) each clause becomes one partition read in
    parallel."""
    opts = jdbc_read_arguments(predicates, **options)
    if predicates:
        url, name = opts.pop("url"), opts.pop("dbtable")
        return spark.read.jdbc(url, name, predicates=predicates, properties=opts)
    return spark.read.format("jdbc").options(**opts).load()
