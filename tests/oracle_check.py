"""Run catalogue queries on Spark and their oracle SQL on DuckDB; compare
row count, schema (normalised type names) and an order-insensitive hash.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

_SPARK_KIND = {
    "bigint": "int64", "int": "int32", "smallint": "int16", "tinyint": "int8",
    "double": "float64", "float": "float32", "string": "string", "boolean": "bool",
    "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp",
}
_DUCK_KIND = {
    "BIGINT": "int64", "INTEGER": "int32", "SMALLINT": "int16", "TINYINT": "int8",
    "DOUBLE": "float64", "FLOAT": "float32", "VARCHAR": "string", "BOOLEAN": "bool",
    "DATE": "date", "TIMESTAMP": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp",
}


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def table_hash(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest()


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    scols = df.columns
    stypes = {f.name: _SPARK_KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    dtypes = {d[0]: _DUCK_KIND.get(str(d[1]), str(d[1])) for d in res.description}
    out = {
        "rows_spark": len(srows), "rows_oracle": len(drows),
        "cols_match": sorted(scols) == sorted(dcols),
        "types_match": stypes == dtypes,
        "hash_match": table_hash(srows, scols) == table_hash(drows, dcols),
        "spark_sec": round(t1 - t0, 2),
    }
    if not out["types_match"]:
        out["types"] = {k: (stypes.get(k), dtypes.get(k)) for k in set(stypes) | set(dtypes)
                        if stypes.get(k) != dtypes.get(k)}
    out["ok"] = (out["rows_spark"] == out["rows_oracle"] and out["cols_match"]
                 and out["types_match"] and out["hash_match"])
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from shiftwise.session import get_session
    import __spark_entry__ as E

    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connect(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as e:  # report and continue
            r = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(f"{'OK ' if r['ok'] else 'BAD'} {name}: {r}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
