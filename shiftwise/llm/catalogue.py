"""The queries ``opN_<name>`` over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from shiftwise.llm import (decontamination, fingerprints, hard_negatives, language, licenses, mixing, prefix_trie,
                           secrets, simhash, suffix_dedup, token_counts, toxicity, warc)
from shiftwise.llm._io import prepare, table
from shiftwise.llm.oracle import ORACLE  # noqa: F401


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.page_report(warc.read_archives(archives, with_payload=False))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_decontamination": op2_decontamination,
    "op3_fingerprints": op3_fingerprints,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_secrets": op7_secrets,
    "op8_token_counts": op8_token_counts,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_warc": op11_warc,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}
