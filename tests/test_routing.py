"""One job that routes every schema of a log table to a table of its own."""

import base64
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from shiftwise.operators.reshape import project_schema, unpack_payload
from shiftwise.plans.payloads import (
    KEY,
    read_schema_table,
    register_schema_tables,
    route_log_table,
    routed,
    schema_tables,
    unpack_log_table,
    write_by_schema,
)
from shiftwise.session import scratch_path
from shiftwise.sources.sinks import write_table


def _payload(text):
    return base64.b64encode(text.encode()).decode()


def _logs(spark, n=40):
    """Schemas of different widths; one name with two types; ragged lines; a header-only file."""
    rng = random.Random(4)
    out = []
    for i in range(n):
        schema = rng.choice(["id, kind", "id,kind", "kind,id,at", "x", "only,header"])
        width = len(schema.split(","))
        lines = [",".join(rng.choice(["1", "22", " a", "b ", "", "2024-01-02"]) for _ in range(width + rng.choice([0, 0, 0, 1, -1])))
                 for _ in range(rng.randint(1, 6))]
        if schema == "only,header":
            lines = []
        head = [schema.replace(" ", "")] if rng.random() < 0.5 or not lines else []
        out.append((i, schema, "t", _payload("\n".join(head + lines) + "\n")))
    path = scratch_path(spark, "logs")
    write_table(spark.createDataFrame(out, "log_id int, LogSchema string, LogSchemaTypes string, LogFile string"), path)
    return path


TYPES = {"id, kind": {"id": "int"}, "kind,id,at": {"id": "bigint", "at": "date"}}


def test_every_schema_equals_its_own_projection(spark):
    path, base = _logs(spark), scratch_path(spark, "tables")
    tables = route_log_table(spark, path, base, types=TYPES, keep=["log_id"])
    assert set(tables) == {"id,kind", "kind,id,at", "x", "only,header"} == set(schema_tables(spark, base))
    long = unpack_log_table(spark, path, keep=["log_id"])
    known = {k.replace(" ", ""): v for k, v in TYPES.items()}
    for schema in tables:
        want = project_schema(long, schema, known.get(schema), keep=["log_id"])
        got = read_schema_table(spark, base, schema)
        assert got.dtypes == want.dtypes and rows(got) == rows(want)
    assert read_schema_table(spark, base, "only,header").count() == 0
    with pytest.raises(KeyError):
        read_schema_table(spark, base, "other")
    views = register_schema_tables(spark, base, "logs_of")
    assert spark.table(views["x"]).columns == ["log_id", "x"]


def test_one_scan_and_one_unpack_for_any_number_of_schemas(spark):
    out = [(i, f"a{i},b", "t", _payload(f"1,{i}\n2,{i}\n")) for i in range(60)]
    path = scratch_path(spark, "logs")
    write_table(spark.createDataFrame(out, "log_id int, LogSchema string, LogSchemaTypes string, LogFile string"), path)
    base = scratch_path(spark, "tables")
    tables = route_log_table(spark, path, base)
    assert len(tables) == 60
    plan = routed(unpack_log_table(spark, path), list(tables.values()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate") == 1
    for i in (0, 17, 59):
        assert rows(read_schema_table(spark, base, f"a{i},b")) == [("1", str(i)), ("2", str(i))]


def test_columns_are_shared_by_position_and_type(spark):
    long = unpack_payload(spark.createDataFrame([("a,b", _payload("1,2\n")), ("c,d,e", _payload("3,4,5\n"))],
                                                "s string, p string"), "s", "p")
    base = scratch_path(spark, "tables")
    write_by_schema(long, base, {"a,b": {"a": "int"}})
    stored = spark.read.parquet(base)
    assert set(stored.columns) == {"f1_int", "f1_string", "f2_string", "f3_string", KEY}
    assert rows(read_schema_table(spark, base, "a,b")) == [(1, "2")]
    scan = read_schema_table(spark, base, "c,d,e").select("d")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<f2_string:string>" in scan and "PartitionFilters: [isnotnull(schema_key" in scan


def test_rewrite_replaces_and_repeated_names_fail(spark):
    base = scratch_path(spark, "tables")
    frame = lambda text: unpack_payload(spark.createDataFrame([("a,b", _payload(text))], "s string, p string"), "s", "p")
    write_by_schema(frame("1,2\n"), base)
    write_by_schema(frame("3,4\n"), base)
    assert rows(read_schema_table(spark, base, "a,b")) == [("3", "4")]
    twice = unpack_payload(spark.createDataFrame([("a,a", _payload("1,2\n"))], "s string, p string"), "s", "p")
    with pytest.raises(ValueError, match="repeats"):
        write_by_schema(twice, base)


def test_no_payloads(spark):
    path, base = scratch_path(spark, "logs"), scratch_path(spark, "tables")
    write_table(spark.createDataFrame([], "LogSchema string, LogFile string"), path)
    assert route_log_table(spark, path, base) == {} == schema_tables(spark, base)


def test_a_schema_with_most_lines_is_split_over_tasks(spark):
    long = spark.range(0, 200_000, 1, 4).select(
        F.when(F.col("id") % 50 == 0, F.lit("c,d")).otherwise(F.lit("a,b")).alias("schema"),
        F.array(F.col("id").cast("string"), F.sha2(F.col("id").cast("string"), 256)).alias("values"))
    base = scratch_path(spark, "tables")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_by_schema(long, base, schemas=["a,b", "c,d"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = (spark.read.parquet(base).withColumn("file", F.input_file_name()).groupBy(KEY)
             .agg(F.countDistinct("file").alias("n"), F.count("*").alias("rows")).orderBy("rows").collect())
    assert files[1]["rows"] == 196_000 and files[1]["n"] > 3
