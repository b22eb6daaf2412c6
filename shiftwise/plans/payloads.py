"""Log tables whose rows carry whole base64 CSV files: unpack to long rows, then
route every schema to a table of its own - all on the executors.

``route_log_table`` writes any number of schemas in one job. A row's fields go to
positional columns, one per (position, type) that some schema uses there (at most
the widest schema's fields times the types in use), and the writer deals rows to
one folder per schema. The log table's payloads are read and unpacked once, and
rows are balanced before the write: small schemas share tasks, a schema that holds
most of the rows is split over several. ``read_schema_table`` and
``register_schema_tables`` give each folder back as a table with the schema's own
column names and types; a scan reads only the fields that are used.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shiftwise.operators.reshape import project_schema, unpack_payload
from shiftwise.sources.readers import read_source
from shiftwise.sources.sinks import write_table

KEY = "schema_key"
MANIFEST = "_tables"  # underscore: not a partition of the routed folder


def unpack_log_table(spark: SparkSession, path: str, fmt: str = "parquet",
                     keep: Sequence[str] = (), schema_col: str = "LogSchema",
                     payload_col: str = "LogFile", repartition: int | None = None) -> DataFrame:
    """Read the log table (only the needed columns reach the scan) and unpack.

    A few rows may hold very large payloads; ``repartition`` spreads the
    exploded lines over more tasks for whatever runs downstream."""
    df = read_source(spark, fmt, path, columns=[*keep, schema_col, payload_col])
    long = unpack_payload(df, schema_col, payload_col, keep=keep)
    return long.repartition(repartition) if repartition else long


def schema_frames(long_df: DataFrame, schemas: Mapping[str, Mapping[str, str] | None],
                  keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """One lazy typed DataFrame per known schema string."""
    return {s: project_schema(long_df, s, types, keep=keep) for s, types in schemas.items()}


def normal_schema(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def schemas_found(df: DataFrame, schema_col: str = "schema", max_schemas: int = 1000) -> list[str]:
    """The distinct schemas of a column, in order. There must be at most
    ``max_schemas``: each becomes a table. On a log table only that column is
    read, no payload."""
    rows = (df.select(normal_schema(F.col(schema_col)).alias("schema")).filter("schema is not null")
            .distinct().limit(max_schemas + 1).collect())
    if len(rows) > max_schemas:
        raise ValueError(f"more than {max_schemas} schemas")
    return sorted(r["schema"] for r in rows)


@dataclass(frozen=True)
class SchemaTable:
    """One routed table: ``fields`` are (name, type, stored column)."""
    schema: str
    path: str
    keep: tuple[str, ...]
    fields: tuple[tuple[str, str, str], ...]


def schema_key(schema: str) -> str:
    """The folder name of a schema: a hash of its text without spaces."""
    return "s" + hashlib.sha256(schema.replace(" ", "").encode()).hexdigest()[:16]


def _tables(schemas: Sequence[str], base: str, types: Mapping[str, Mapping[str, str]] | None,
            keep: Sequence[str]) -> list[SchemaTable]:
    known = {s.replace(" ", ""): dict(t or {}) for s, t in (types or {}).items()}
    out = []
    for schema in dict.fromkeys(s.replace(" ", "") for s in schemas):
        names = schema.split(",")
        if len(set(names) | set(keep)) < len(names) + len(set(keep)):
            raise ValueError(f"schema {schema!r}: a name repeats or is one of {list(keep)}")
        kinds = known.get(schema, {})
        fields = []
        for i, name in enumerate(names, 1):
            kind = kinds.get(name, "string")
            tag = "".join(c if c.isalnum() else "_" for c in kind.lower())
            fields.append((name, kind, f"f{i}_{tag}"))
        out.append(SchemaTable(schema, f"{base}/{KEY}={schema_key(schema)}", tuple(keep), tuple(fields)))
    if len({t.path for t in out}) < len(out):
        raise ValueError("two schemas share a key")
    return out


def routed(long_df: DataFrame, tables: Sequence[SchemaTable], keep: Sequence[str] = ()) -> DataFrame:
    """Unpacked rows with their schema's key and its fields in positional columns
    (``try_cast``: text that does not fit is NULL); rows of no listed schema go."""
    key = F.lit(None).cast("string")
    users: dict[str, tuple[int, str, list[str]]] = {}
    pairs = []
    for t in tables:
        pairs += [F.lit(t.schema), F.lit(schema_key(t.schema))]
        for i, (_, kind, stored) in enumerate(t.fields):
            users.setdefault(stored, (i, kind, []))[2].append(t.schema)
    if pairs:
        key = F.try_element_at(F.create_map(*pairs), F.col("schema"))
    cols = []
    for stored in sorted(users, key=lambda s: (users[s][0], s)):
        i, kind, schemas = users[stored]
        value = F.get(F.col("values"), i)
        value = value if kind == "string" else value.try_cast(kind)
        mine = value if len(schemas) == len(tables) else F.when(F.col("schema").isin(schemas), value)
        cols.append(mine.alias(stored))
    if not cols:  # no schema: an empty table still has a column
        cols = [F.lit(None).cast("string").alias("f1_string")]
    return long_df.select(*keep, *cols, key.alias(KEY)).filter(F.col(KEY).isNotNull())


def write_by_schema(long_df: DataFrame, base: str, types: Mapping[str, Mapping[str, str]] | None = None,
                    keep: Sequence[str] = (), fmt: str = "parquet",
                    schemas: Sequence[str] | None = None) -> dict[str, SchemaTable]:
    """Write every schema to a folder of its own below ``base`` in one job;
    returns schema -> table. Without ``schemas`` they are first collected from
    ``long_df``, which unpacks it once more: ``route_log_table`` reads them from
    the log table's schema column instead."""
    spark, base = long_df.sparkSession, base.rstrip("/")
    tables = _tables(schemas_found(long_df) if schemas is None else schemas, base, types, keep)
    rows = routed(long_df, tables, keep)
    write_table(rows.hint("rebalance", F.col(KEY)), base, fmt=fmt, partition_by=[KEY])
    listed = [(t.schema, t.path, list(t.keep), [list(f) for f in t.fields], fmt, rows.schema.json()) for t in tables]
    manifest = spark.createDataFrame(listed, "schema string, path string, keep array<string>, "
                                             "fields array<array<string>>, format string, stored string")
    write_table(manifest.coalesce(1), f"{base}/{MANIFEST}")
    return {t.schema: t for t in tables}


def route_log_table(spark: SparkSession, path: str, base: str, fmt: str = "parquet",
                    types: Mapping[str, Mapping[str, str]] | None = None, keep: Sequence[str] = (),
                    schema_col: str = "LogSchema", payload_col: str = "LogFile") -> dict[str, SchemaTable]:
    """Unpack a log table and write one table per schema found below ``base``."""
    found = schemas_found(read_source(spark, fmt, path, columns=[schema_col]), schema_col)
    long = unpack_log_table(spark, path, fmt, keep, schema_col, payload_col)
    return write_by_schema(long, base, types, keep, schemas=found)


def _manifest(spark: SparkSession, base: str) -> list:
    return spark.read.parquet(f"{base.rstrip('/')}/{MANIFEST}").collect()


def schema_tables(spark: SparkSession, base: str) -> dict[str, SchemaTable]:
    """The tables below ``base``, as their writer listed them."""
    return {r["schema"]: SchemaTable(r["schema"], r["path"], tuple(r["keep"]), tuple(tuple(f) for f in r["fields"]))
            for r in _manifest(spark, base)}


def read_schema_table(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """One schema's rows with its own column names and types. A schema whose
    payloads hold no data line is an empty table."""
    schema = schema.replace(" ", "")
    found = [r for r in _manifest(spark, base) if r["schema"] == schema]
    if not found:
        raise KeyError(schema)
    row = found[0]
    stored = spark.read.format(row["format"]).schema(StructType.fromJson(json.loads(row["stored"]))).load(base)
    mine = stored.filter(F.col(KEY) == schema_key(schema))
    return mine.select(*row["keep"], *[F.col(c).alias(name) for name, _, c in row["fields"]])


def register_schema_tables(spark: SparkSession, base: str, prefix: str) -> dict[str, str]:
    """Temporary views ``prefix_<key>`` over all tables below ``base``; returns
    schema -> view."""
    out = {}
    for schema in schema_tables(spark, base):
        name = f"{prefix}_{schema_key(schema)}"
        read_schema_table(spark, base, schema).createOrReplaceTempView(name)
        out[schema] = name
    return out
