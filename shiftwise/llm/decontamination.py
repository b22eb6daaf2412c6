"""Benchmark decontamination as a prefix-filtered set join.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased. An item is cut into windows of ``window`` consecutive words (a
shorter item, but not an empty one, is one window); a window is a set of
shingles of ``shingle`` words at fixed offsets (a window of fewer words is one
shingle). A document stretch matches a window when it holds at least
``containment`` of the window's shingles at their offsets; at 1.0 this is
exact containment.

Steps:

1. The distinct item shingles are looked up in every whole text. The look-up is
   a semi-join by 64-bit hash inside the one Arrow pass that splits the texts,
   as long as the shingles are at most ``filter_rows`` (checked by a count);
   beyond that every shingle of every text leaves the pass and an ordinary
   Spark semi-join on the shingle text takes its place. What remains are the
   true occurrences: document row, word position, shingle text.
2. Rarity: occurrences counted per shingle over the whole corpus. Each window's
   shingles are ordered from the rarest, and only the first
   ``S - ceil(containment * S) + 1`` of its S shingles (the prefix: without one
   of these the overlap can't be reached) are joined with the occurrences.
3. Length and positional bounds drop candidates that would begin before the
   text's first word or end after its last.
4. Verification joins the candidates' expected shingles with the occurrences at
   their exact positions and compares shingle texts, not hashes.
5. Matches are merged to hit word counts and item lists per document row.

Edge cases: null texts and texts without words have no hits and are not
contaminated; null item ids are ignored in ``n_items`` and the digest but their
windows still count as hits; repeated document rows are judged row by row;
items that repeat (same id or same text) count once per id; an empty benchmark
leaves every document clean. Other columns are not read.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm import _text
from shiftwise.llm._io import ascii_lower, materialise, prepare, stable_input

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_windows(items: DataFrame, window: int = 10, id_col: str = "item_id",
                 text: str = "text") -> DataFrame:
    """(item_id, window_id, words) for every window of every item."""
    words = F.filter(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), WORD_GAP),
                     lambda w: w != "")
    rows = (items.select(F.col(id_col).cast("string").alias("item_id"), words.alias("w"))
            .filter(F.size("w") > 0)
            .withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))))
            .select("item_id", F.slice("w", F.col("at"), window).alias("words")))
    return rows.distinct().withColumn("window_id", F.sha2(F.concat_ws(" ", "words"), 256))


def window_shingles(windows: DataFrame, shingle: int = 5) -> DataFrame:
    """(window_id, n_words, n_shingles, offset, shingle) per distinct window."""
    k = F.least(F.size("words"), F.lit(shingle))
    return (windows.select("window_id", "words").distinct()
            .select("window_id", F.size("words").alias("n_words"),
                    (F.size("words") - k + 1).alias("n_shingles"), "words", k.alias("k"),
                    F.explode(F.sequence(F.lit(0), F.size("words") - k)).alias("offset"))
            .select("window_id", "n_words", "n_shingles", "offset",
                    F.concat_ws(" ", F.slice("words", F.col("offset") + 1, F.col("k"))).alias("shingle")))


def _hashes(grams: list[str]) -> dict[int, np.ndarray]:
    """Sorted shingle hashes by number of words."""
    by: dict[int, list[str]] = {}
    for g in grams:
        by.setdefault(g.count(" ") + 1, []).append(g)
    out = {}
    for k, own in by.items():
        w = _text.split_words(pa.array(own, pa.large_string()), _text.NONSPACE)
        h = _text.gram_hash(_text.range_hash(w.data, w.start, w.end)[0], k)
        out[k] = np.unique(h[w.first[:-1]])
    return out


def _occurrences(batches: Iterator[pa.RecordBatch], wanted: dict[int, np.ndarray],
                 all_lengths: tuple[int, ...] = ()) -> Iterator[pa.RecordBatch]:
    """(row_id, text) -> (row_id, n_words, hits): the wanted shingles of each
    text (every shingle of ``all_lengths`` words if that is given)."""
    hit = pa.struct([("pos", pa.int32()), ("shingle", pa.string())])
    for batch in batches:
        texts = batch.column("text").fill_null("").cast(pa.large_string())
        n_words = np.zeros(len(texts), dtype=np.int64)
        rows, pos, grams = [], [], []
        for i, j in _text.slices(texts):
            w = _text.split_words(texts.slice(i, j - i), _text.ALNUM)
            n_words[i:j] = w.counts
            if not len(w.start):
                continue
            owner = w.text_of_word()
            left = w.first[1:][owner] - np.arange(len(owner))  # words up to the text's end
            word_hash = _text.range_hash(w.data, w.start, w.end)[0] if wanted else None
            raw = w.data.tobytes()
            for k in all_lengths or sorted(wanted):
                ok = left >= k
                if not all_lengths:
                    h = _text.gram_hash(word_hash, k)
                    table = wanted[k]
                    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
                    ok = ok[:len(h)] & (table[at] == h)
                for p in np.flatnonzero(ok).tolist():
                    rows.append(i + int(owner[p]))
                    pos.append(p - int(w.first[owner[p]]))
                    grams.append(b" ".join(raw[w.start[p]:w.end[p + k - 1]].split()).decode("utf-8", "replace"))
        order = np.argsort(np.array(rows, dtype=np.int64), kind="stable")
        bounds = np.searchsorted(np.array(rows, dtype=np.int64)[order], np.arange(len(texts) + 1))
        values = pa.StructArray.from_arrays(
            [pa.array(np.array(pos, dtype=np.int32)[order]), pa.array(grams, pa.string()).take(pa.array(order))],
            fields=list(hit))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), pa.array(n_words),
             pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)],
            names=["row_id", "n_words", "hits"])


def matches(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5,
            containment: float = 1.0, id_col: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text",
            filter_rows: int = 500_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, found, windows): rows has (row_id, doc_id, n_words) per document
    row; found has (row_id, window_id, begin, n_words) per matched stretch;
    windows has (item_id, window_id, words)."""
    if not 0 < containment <= 1:
        raise ValueError("containment must be in (0, 1]")
    spark = docs.sparkSession
    prepare(spark)
    docs = stable_input(docs.select(id_col, text), "bench-texts")
    windows = materialise(item_windows(items, window, item_id, item_text), "bench-windows")
    parts = materialise(window_shingles(windows, shingle), "bench-shingles")
    grams = parts.select("shingle").distinct()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"),
                         F.monotonically_increasing_id().alias("row_id"))
    known = grams.count()  # the benchmark's distinct shingles
    schema = "row_id long, n_words long, hits array<struct<pos int, shingle string>>"
    ids = source.select("row_id", "doc_id")

    if known <= filter_rows:
        wanted = _hashes([r["shingle"] for r in grams.collect()])  # at most filter_rows
        sent = spark.sparkContext.broadcast(wanted)
        seen = source.select("doc_id", "row_id", "text")
        out = seen.mapInArrow(lambda it: _with_id(it, sent.value, ()), "doc_id " +
                              dict(ids.dtypes)["doc_id"] + ", " + schema)
        rows = materialise(out, "bench-hits")
        hits = rows.select("row_id", F.inline("hits"))
    else:
        lengths = tuple(sorted(r["k"] for r in parts.select(
            F.least("n_words", F.lit(shingle)).alias("k")).distinct().collect()))  # 1..shingle
        out = source.mapInArrow(lambda it: _with_id(it, {}, lengths), "doc_id " +
                                dict(ids.dtypes)["doc_id"] + ", " + schema)
        rows = materialise(out, "bench-hits")
        hits = rows.select("row_id", F.inline("hits")).join(grams, "shingle", "left_semi")

    # Rarity over the whole corpus; the prefix of each window in that order.
    rarity = hits.groupBy("shingle").agg(F.count("*").alias("seen"))
    need = F.ceil(F.lit(containment) * F.col("n_shingles") - 1e-9)
    rank = Window.partitionBy("window_id").orderBy(F.coalesce("seen", F.lit(0)), "shingle", "offset")
    prefix = (parts.join(rarity, "shingle", "left")
              .withColumn("rank", F.row_number().over(rank))
              .filter(F.col("rank") <= F.col("n_shingles") - need + 1)
              .filter("seen is not null")
              .select("shingle", "window_id", "offset", F.col("n_words").alias("length"),
                      "n_shingles", need.alias("need")))
    candidates = (hits.join(prefix, "shingle")
                  .select("row_id", "window_id", (F.col("pos") - F.col("offset")).alias("begin"),
                          "length", "n_shingles", "need").distinct()
                  .join(rows.select("row_id", "n_words"), "row_id")
                  .filter("begin >= 0 and begin + length <= n_words").drop("n_words"))
    # Verification at exact positions, on shingle texts.
    expected = (candidates.join(parts.select("window_id", "offset", "shingle"), "window_id")
                .withColumn("pos", F.col("begin") + F.col("offset")))
    found = (expected.join(hits, ["row_id", "pos", "shingle"])
             .groupBy("row_id", "window_id", "begin", "length", "need").agg(F.count("*").alias("held"))
             .filter("held >= need")
             .select("row_id", "window_id", "begin", F.col("length").alias("n_words")))
    return rows.select("row_id", "doc_id", "n_words"), found, windows


def _with_id(batches, wanted, lengths):
    for batch in batches:
        if not batch.num_rows:
            continue
        got = next(_occurrences(iter([batch]), wanted, lengths))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *got.columns],
                                         names=["doc_id", *got.schema.names])


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated (options: see ``matches``)."""
    rows, found, windows = matches(docs, items, **options)
    found = materialise(found, "bench-found")
    before = (Window.partitionBy("row_id").orderBy("begin", "end")
              .rowsBetween(Window.unboundedPreceding, -1))
    hit = (found.select("row_id", "begin", (F.col("begin") + F.col("n_words")).alias("end")).distinct()
           .withColumn("fresh", F.col("end") - F.greatest("begin", F.least(
               "end", F.coalesce(F.max("end").over(before), F.lit(0)))))
           .groupBy("row_id").agg(F.sum("fresh").cast("long").alias("n_hit")))
    items_of = (found.select("row_id", "window_id").distinct()
                .join(windows.select("window_id", "item_id").filter("item_id is not null").distinct(),
                      "window_id")
                .groupBy("row_id").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    none = F.array().cast("array<string>")
    return (rows.join(hit, "row_id", "left").join(items_of, "row_id", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", none).alias("items"))
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def drop_contaminated_rows(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs, whatever
    their ids: the verdict depends on the text alone and is carried by its hash
    and the id (so that copies of a text do not meet in one task)."""
    key = F.concat_ws(":", F.sha2(F.coalesce(F.col(text), F.lit("")), 256), F.col("doc_id").cast("string"))
    bad = (contamination(docs.select(key.alias("__key"), text), items, id_col="__key", text=text, **options)
           .filter("contaminated").select(F.col("doc_id").alias("__bad")).distinct())
    return docs.join(bad, key == bad["__bad"], "left_anti")
