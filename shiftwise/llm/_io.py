"""Tables, scratch tables and session settings shared by the operators."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.session import ensure_checkpoint_dir, scratch_path

#: Rows per Arrow batch handed to Python: bounds a worker's memory on long texts.
ARROW_ROWS = 512

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """What every operator relies on (idempotent): small Arrow batches, a shared
    checkpoint folder, and this package on the Python workers' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="shiftwise-py-"), "shiftwise_py.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(root)))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage: what is computed once is not computed again, and a lost
    executor loses none of it. ``session.release_scratch`` (also run when the
    program ends) removes the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stable_input(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` in a form whose rows are numbered alike however often it is read:
    itself when it is a projection or filter of stored files, else a stored copy
    (a shuffle may deal rows otherwise when other columns are asked for)."""
    def only_reads(node) -> bool:
        if node.nodeName() not in ("Project", "Filter", "LogicalRelation", "SubqueryAlias"):
            return False
        return all(only_reads(node.children().apply(i)) for i in range(node.children().size()))

    plan = docs._jdf.queryExecution().optimizedPlan()
    return docs if only_reads(plan) else materialise(docs, name)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does so when
    the driver's JVM finds nothing refers to them any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def fresh_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` does not have (names differ by
    more than case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def sortable(df: DataFrame) -> list[Column]:
    """The columns of ``df`` in a form that has an order and a hash: maps as sorted
    entries, variants as text."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("map<"):
            c = F.array_sort(F.map_entries(c))
        elif "map<" in kind or "variant" in kind:
            c = F.to_json(F.struct(c))
        out.append(c)
    return out
