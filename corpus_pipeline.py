"""The corpus pipeline: documents pass the stages of ``STAGES`` in order.

Every stage is a function ``(spark, docs, sf_dir) -> DataFrame`` over all that
its predecessor kept; its result is written as Parquet and read again as the
next one's ``docs``. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.llm import decontamination, mixing, secrets, simhash, toxicity
from shiftwise.llm._io import fresh_names, materialise, prepare, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    model = toxicity.train(docs, labels)
    (score,) = fresh_names(docs, "score")
    kept = docs.withColumn(score, toxicity.score(docs, model))
    return kept.filter(F.col(score) < toxicity.threshold(model)).drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits)."""
    prepare(spark)
    return simhash.keep_one_per_group(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no 10-word window of a benchmark item occurs."""
    prepare(spark)
    return decontamination.drop_contaminated_rows(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask."""
    prepare(spark)
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes words of, with size, source_size, target, taken."""
    prepare(spark)
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: A trained classifier, SimHash and seeded choices are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
