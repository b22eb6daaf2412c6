"""Document fingerprints: a Merkle tree over sections and paragraphs.

Sections are the text cut at blank lines (two line feeds), paragraphs a section
cut at line feeds. A paragraph's digest is SHA-256 of its text, a section's
SHA-256 of its paragraphs' digests, the root (the fingerprint) SHA-256 of the
sections' digests: equal roots mean equal texts, and where two roots differ the
differing branches lead to the edited sections and paragraphs
(``first_difference``). Below a paragraph hang leaves of up to ``LEAF_WORDS``
words; the likeness of two trees is the Dice coefficient of their sets of
leaves (1 when the roots are equal).

``with_next`` finds each document's successor in descending id order without a
global sort: ids are cut at approximate quantiles and each part again into even
slices of about ``slice_rows`` rows. The text is shuffled once, by slice; a
window inside each slice gives the successor, and a slice's last row takes the
first row of the slice below (one row per slice moves).

Edge cases: a null text is an empty text; null ids come last in descending
order, among themselves by a hash of the text; rows of one id are ordered by
text (exact copies are interchangeable); a single row is its own successor; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm._io import prepare

LEAF_WORDS = 4
LEAF = r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){1,%d}[\x20\x09-\x0D]*|[\x20\x09-\x0D]+" % LEAF_WORDS
QUANTILES = 64


def tree(text: Column) -> Column:
    """array<section: array<paragraph: struct<digest string, leaves array<bigint>>>>."""
    return F.transform(F.split(text, "\n\n", -1), lambda s: F.transform(
        F.split(s, "\n", -1), lambda p: F.struct(
            F.sha2(p, 256).alias("digest"),
            F.transform(F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)),
                        lambda x: F.xxhash64(x)).alias("leaves"))))


def section_digests(t: Column) -> Column:
    return F.transform(t, lambda s: F.sha2(F.concat_ws("", F.transform(s, lambda p: p["digest"])), 256))


def root(t: Column) -> Column:
    return F.sha2(F.concat_ws("", section_digests(t)), 256)


def leaves(t: Column) -> Column:
    """The set of leaf hashes of a tree."""
    return F.array_distinct(F.flatten(F.flatten(F.transform(t, lambda s: F.transform(s, lambda p: p["leaves"])))))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    both = F.size(F.array_intersect(leaves_a, leaves_b))
    total = F.size(leaves_a) + F.size(leaves_b)
    return F.when(root_a == root_b, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(2.0 * both / total)


def first_difference(a: Column, b: Column) -> Column:
    """"section:paragraph" (from 0) of the first branch of tree ``a`` that
    differs from the same place in ``b``; null when the trees agree."""
    da, db = section_digests(a), section_digests(b)
    s = F.array_position(F.transform(F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1),
                                     lambda i: F.get(da, i).eqNullSafe(F.get(db, i))), False) - 1
    none = F.array().cast("array<struct<digest:string,leaves:array<bigint>>>")
    pa, pb = (F.coalesce(F.get(t, s.cast("int")), none) for t in (a, b))
    p = F.array_position(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(pa), F.size(pb), F.lit(1)) - 1),
        lambda i: F.get(pa, i)["digest"].eqNullSafe(F.get(pb, i)["digest"])), False) - 1
    return F.when(s >= 0, F.concat_ws(":", s.cast("string"), p.cast("string")))


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
              slice_rows: int = 2000) -> DataFrame:
    """(doc_id, text, next_text) in descending id order, last to first."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    at = [(i + 1) / QUANTILES for i in range(QUANTILES - 1)]
    s = rows.agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                 F.percentile_approx("doc_id", at, 10_000).alias("cuts")).first()
    slices = max(1, -(-s["n"] // (QUANTILES * slice_rows)))
    low, high = (s["low"] or 0), (s["high"] or 0)
    cuts = sorted(set(s["cuts"] or [])) or [low]
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    edges = F.split(F.lit(",".join(map(str, [low, *cuts, high + 1]))), ",").cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda c: F.col("doc_id") >= c))
    floor, ceiling = F.get(edges, F.col("part")), F.get(edges, F.col("part") + 1)
    inside = ((F.col("doc_id") - floor).cast("double") / F.greatest(ceiling - floor, F.lit(1)) * slices)
    slot = F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64("text"), F.lit(slices * QUANTILES))).otherwise(
        F.col("part").cast("long") * slices + F.least(F.floor(inside), F.lit(slices - 1)))
    sliced = rows.withColumn("part", part).select("doc_id", "text", slot.alias("slot"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").asc(), F.col("text").asc()]
    place = Window.partitionBy("slot").orderBy(*order)
    placed = (sliced.withColumn("first", F.row_number().over(place) == 1)
              .withColumn("next_text", F.lead("text").over(place)))
    # One row per slice: its first text belongs to the slice above (the highest's to the lowest).
    used = sliced.select("slot").distinct()
    ring = Window.orderBy("slot")
    above = used.select("slot", F.coalesce(F.lead("slot").over(ring), F.min("slot").over(
        Window.partitionBy())).alias("user"))
    heads = (placed.filter("first").select("slot", F.col("text").alias("head"))
             .join(above, "slot").select(F.col("user").alias("slot"), "head"))
    return (placed.join(heads, "slot")
            .select("doc_id", "text", F.coalesce("next_text", "head").alias("next_text")))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, first_edit (section:paragraph).

    The edited text has its last floor(n / 2) code points replaced by the first
    as many (or all) of the successor's text."""
    t, nxt, n = F.col("text"), F.col("next_text"), F.col("n_chars")
    half = F.floor(n / 2).cast("int")
    pairs = (with_next(docs, id_col, text).withColumn("n_chars", F.length("text"))
             .withColumn("edited", F.concat(F.substring(t, F.lit(1), n - half), F.substring(nxt, F.lit(1), half))))
    trees = pairs.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                         tree(t).alias("a"), tree(F.col("edited")).alias("b"), tree(nxt).alias("c"))
    parts = trees.select("doc_id", "n_chars", "edited_sha256", "a", "b",
                         *[f(F.col(x)).alias(f"{name}_{x}") for x in "abc"
                           for name, f in (("root", root), ("leaves", leaves))])
    return parts.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        F.col("root_a").alias("fingerprint"), F.col("root_b").alias("edited_fingerprint"),
        likeness(F.col("root_a"), F.col("leaves_a"), F.col("root_b"), F.col("leaves_b")).alias("near_edited"),
        likeness(F.col("root_a"), F.col("leaves_a"), F.col("root_c"), F.col("leaves_c")).alias("near_next"),
        first_difference(F.col("a"), F.col("b")).alias("first_edit"))
