"""Language ID of web pages by Bayesian evidence fusion.

Four pieces of evidence per page, added as log probabilities per language:

* text: naive Bayes over hashed features of the visible words (the word, its
  first and its last three bytes), fitted on at most ``per_lang`` labelled
  documents per language; the mean per word counts as at most ``max_words``
  independent words;
* declared markup language (``<html lang=...>``) and language code in the
  address's first path segment: P(value | language), from grouped sums of the
  text posteriors over all pages, smoothed with a prior that the value tells
  the truth;
* address suffix (the host's last label): P(suffix | language), likewise;
* host prior: posterior mass per host, shrunk towards its registered domain,
  that towards the suffix, that towards all pages, each by a grouped
  aggregation; a page's own mass is taken out of its host's sum before use.

Scale: pages are read once; what goes on is one small row per page. All tables
(values, suffixes, domains, hosts) are grouped aggregates combined map-side and
joined by key, so a host with a third of all pages costs one partial row per
task, and adaptive execution splits its join.

Edge cases: a null or empty page has no text evidence, a null or malformed
address no host (all such pages share the global prior); pages without any
evidence get the most frequent language; without labelled documents the result
has null languages; ties go to the first language in code point order; repeated
rows count as pages of their own. Other columns are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm import _text
from shiftwise.llm._io import materialise, prepare

BUCKETS = 1 << 16
MAX_LANGUAGES = 256


def visible_text(html: Column) -> Column:
    """Text of a page without scripts, styles, navigation, comments and tags."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style|nav|head)\b.*?</\1>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(out, r"<[^>]*>", " "), r"&#?\w{1,8};", " ")


def declared(html: Column) -> Column:
    """Primary subtag of the page's declared language, lower case."""
    return F.nullif(F.lower(F.regexp_extract(
        F.coalesce(html, F.lit("")), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", 1)), F.lit(""))


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit(""))


def path_code(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/([A-Za-z]{2})(?:[/?#]|$)", 1)), F.lit(""))


def _features(w: _text.Words) -> np.ndarray:
    whole, head = _text.range_hash(w.data, w.start, w.end, np.minimum(w.end, w.start + 3))
    tail = _text.range_hash(w.data, np.maximum(w.start, w.end - 3), w.end)[0]
    salt = (np.uint64(0), np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))
    return np.stack([((h ^ s) % np.uint64(BUCKETS)).astype(np.int32)
                     for h, s in zip((whole, head, tail), salt)], axis=1)


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, feature, n) of the texts of a batch."""
    for batch in batches:
        langs, owner = np.unique(np.array(batch.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        texts = batch.column("text").fill_null("").cast(pa.large_string())
        total: dict[int, np.ndarray] = {}
        for i, j in _text.slices(texts, 1 << 18):
            w = _text.split_words(texts.slice(i, j - i), _text.ALNUM)
            cell = owner[i + w.text_of_word()][:, None] * BUCKETS + _features(w)
            for at, n in zip(*np.unique(cell, return_counts=True)):
                total[at] = total.get(at, 0) + n
        cells = np.fromiter(total, np.int64, len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs[cells // BUCKETS].astype(object), pa.string()), pa.array(cells % BUCKETS, pa.int32()),
             pa.array(np.fromiter(total.values(), np.int64, len(total)))], names=["lang", "feature", "n"])


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          per_lang: int = 400, max_languages: int = MAX_LANGUAGES) -> tuple[list[str], np.ndarray]:
    """(languages, log P(feature | language)) from at most ``per_lang`` labelled
    documents of each language (one row of each: of rows that share an id and a
    language the least text). Features are counted in the executors: what reaches
    the driver is one number per language and feature, however long texts are.

    All languages are modelled. The table has ``BUCKETS`` numbers for each and goes to
    every task, so more than ``max_languages`` of them are an error, not a cut."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(lang).cast("string").alias("lang"),
                         F.col(text).alias("text")).filter("id is not null and lang is not null")
    known = source.select("lang").distinct().limit(max_languages + 1).collect()
    if len(known) > max_languages:
        raise ValueError(f"more than {max_languages} languages: raise max_languages and the executors' memory")
    langs = sorted(r["lang"] for r in known)
    if not langs:
        return [], np.zeros((0, BUCKETS), np.float32)
    # The first of each part of a language, then of those the first: what meets in one
    # task is bounded, whatever the language and the number of tasks.
    order = [F.xxhash64("id"), F.col("id")]
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64)).alias("part")
    some = (source.select("id", "lang", part).distinct()
            .withColumn("k", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .filter(F.col("k") <= per_lang))
    picked = (some.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .filter(F.col("k") <= per_lang).select("id", "lang"))
    rows = (source.join(F.broadcast(picked), ["id", "lang"])  # at most per_lang ids each
            .groupBy("id", "lang").agg(F.min(F.struct("text")).alias("t")).select("lang", "t.text"))
    counts = (rows.mapInArrow(_feature_counts, "lang string, feature int, n long")
              .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow())
    total = np.zeros((len(langs), BUCKETS))
    at = {name: i for i, name in enumerate(langs)}
    which = np.array([at[x] for x in counts.column("lang").to_pylist()], np.int64)
    total[which, counts.column("feature").to_numpy()] = counts.column("n").to_numpy()
    total += 0.2
    return langs, np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(texts: pa.Array, table: np.ndarray, max_words: int) -> np.ndarray:
    """Log likelihood per language (rows: texts), the best of a row being 0."""
    texts = texts.fill_null("").cast(pa.large_string())
    out = np.zeros((len(texts), len(table)))
    by_feature = np.ascontiguousarray(table.T)
    for i, j in _text.slices(texts):
        w = _text.split_words(texts.slice(i, j - i), _text.ALNUM)
        if not len(w.start):
            continue
        f = _features(w)
        score = (by_feature[f[:, 0]] + by_feature[f[:, 1]] + by_feature[f[:, 2]]) / 3
        full = np.flatnonzero(w.counts)
        n = w.counts[full][:, None]
        out[i + full] = np.add.reduceat(score, w.first[:-1][full], axis=0) / n * np.minimum(n, max_words)
    return out - out.max(axis=1, keepdims=True, initial=-np.inf)


def _sums(langs: list[str]) -> list[Column]:
    return [F.sum(F.get("post", F.lit(i))).alias(f"m{i}") for i in range(len(langs))]


def _mass(n: int) -> Column:
    return F.array(*[F.col(f"m{i}") for i in range(n)])


def _shrink(own: Column, parent: Column, strength: float) -> Column:
    """(own + strength * parent) / (sum(own) + strength)."""
    total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x) + strength
    return F.transform(own, lambda x, i: (x + strength * F.get(parent, i)) / total)


def identify(pages: DataFrame, docs: DataFrame, per_lang: int = 400, max_words: int = 40,
             strength: float = 5.0, trust: float = 20.0, id_col: str = "page_id") -> DataFrame:
    """One row per page: page_id, lang, confidence, text_lang, declared_lang,
    path_lang, host."""
    spark = pages.sparkSession
    prepare(spark)
    langs, table = train(docs, per_lang=per_lang)
    k = len(langs)
    sent = spark.sparkContext.broadcast(table)

    @F.arrow_udf("array<double>")
    def evidence(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(list(text_evidence(texts, sent.value, max_words)), pa.list_(pa.float64()))

    base = pages.select(F.col(id_col).alias("page_id"), host(F.col("url")).alias("host"),
                        path_code(F.col("url")).alias("path_lang"), declared(F.col("html")).alias("declared_lang"),
                        F.monotonically_increasing_id().alias("row"),
                        evidence(visible_text(F.col("html"))).alias("ll") if k
                        else F.array().cast("array<double>").alias("ll"))
    if not k:
        return base.select("page_id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                           F.lit(None).cast("string").alias("text_lang"), "declared_lang", "path_lang", "host")
    up = F.transform("ll", lambda x: F.exp(x))
    norm = F.aggregate("up", F.lit(0.0), lambda a, x: a + x)
    labels = F.slice(F.split("host", r"\."), -2, 2)
    rows = materialise(
        base.withColumn("up", up).withColumn("norm", norm)
        .withColumn("post", F.transform("up", lambda x: x / F.col("norm")))
        .withColumn("suffix", F.element_at(F.split("host", r"\."), -1))
        .withColumn("domain", F.when(F.size(F.split("host", r"\.")) >= 2, F.concat_ws(".", labels))
                    .otherwise(F.col("host"))).drop("up", "norm"), "pages")

    # Mass per host, domain, suffix and overall.
    hosts = materialise(rows.groupBy("host", "domain", "suffix").agg(*_sums(langs)), "page-hosts")
    up_sums = [F.sum(f"m{i}").alias(f"m{i}") for i in range(k)]
    overall = hosts.agg(*up_sums).first()
    total = sum(x or 0.0 for x in overall) + k
    everywhere = F.array(*[F.lit(((x or 0.0) + 1) / total) for x in overall])
    suffixes = (hosts.filter("suffix is not null").groupBy("suffix").agg(*up_sums)
                .withColumn("p_suffix", _shrink(_mass(k), everywhere, strength)))
    domains = (hosts.filter("domain is not null").groupBy("domain", "suffix").agg(*up_sums)
               .join(suffixes.select("suffix", "p_suffix"), "suffix")
               .withColumn("p_domain", _shrink(_mass(k), F.col("p_suffix"), strength)))
    priors = (hosts.filter("host is not null").join(domains.select("domain", "p_domain"), "domain")
              .select("host", _mass(k).alias("mass"), "p_domain"))

    # P(value | language) for declared and path codes, and for suffixes.
    def likelihood(column: str, truth: bool) -> DataFrame:
        seen = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(*_sums(langs))
        prior = [F.when(F.col(column) == name, F.lit(trust)).otherwise(F.lit(0.0)) if truth else F.lit(0.0)
                 for name in langs]
        all_mass = rows.filter(F.col(column).isNotNull()).agg(*_sums(langs)).first()
        return seen.select(F.col(column).alias("value"), F.array(*[
            F.log((F.col(f"m{i}") + prior[i] + 0.5) / F.lit((all_mass[i] or 0.0) + trust + 5.0))
            for i in range(k)]).alias("e_" + column))

    flat = F.array(*[F.lit(0.0)] * k)
    out = rows
    for column, truth in (("declared_lang", True), ("path_lang", True), ("suffix", False)):
        table_of = likelihood(column, truth)
        out = out.join(table_of, F.col(column) == F.col("value"), "left").drop("value")
    out = out.join(priors.withColumnRenamed("host", "h"), F.col("host") == F.col("h"), "left").drop("h")
    rest = F.transform("mass", lambda x, i: F.greatest(x - F.get("post", i), F.lit(0.0)))
    prior = F.coalesce(_shrink(rest, F.col("p_domain"), strength), everywhere)
    logs = F.transform(prior, lambda x, i: F.log(x) + F.get("ll", i)
                       + F.get(F.coalesce("e_declared_lang", flat), i)
                       + F.get(F.coalesce("e_path_lang", flat), i) + F.get(F.coalesce("e_suffix", flat), i))
    names = F.array(*[F.lit(x) for x in langs])

    def best(c: str) -> Column:
        return F.get(names, (F.array_position(F.col(c), F.array_max(c)) - 1).cast("int"))

    return (out.withColumn("log", logs)
            .withColumn("confidence", 1 / F.aggregate(
                F.transform("log", lambda x: F.exp(x - F.array_max("log"))), F.lit(0.0), lambda a, x: a + x))
            .select("page_id", best("log").alias("lang"), "confidence",
                    F.when(F.array_min("ll") < 0, best("ll")).alias("text_lang"),
                    "declared_lang", "path_lang", "host"))
