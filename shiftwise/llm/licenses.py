"""License scans by diagonal voting, all DataFrame code.

Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Every run of ``k`` words of every text is hashed and joined with the k-grams of
the templates (a fixed list: at most ``max_grams`` rows, checked when it is
built, so it is broadcast and texts are never shuffled). A match votes for the
diagonal document position - template position; the words behind equal hashes
are compared before the vote counts. Votes are summed per (row, template,
diagonal); diagonals of one template whose places lie within ``max_shift``
words of each other (an inserted or missing word moves the diagonal) are merged
to one span, and a span is verified: the share of the template's k-grams it
holds, each template position counted once, must reach ``min_cover``.

A phrase is a template too: it stands consecutively where one diagonal holds
all of its k-grams, each checked by its words, which is the exact match.

Edge cases: a null or empty text has no words, places or labels; texts or
templates of fewer than ``k`` words have no k-gram (templates of fewer words
are refused); overlapping places all count; repeated rows are judged row by
row. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftwise.llm._io import ascii_lower, materialise, prepare, stable_input

WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: Public notices of common licenses and their labels.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files the software to deal in the software without restriction", "mit"),
    ("the software is provided as is without warranty of any kind express or implied", "mit"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in "
     "compliance with the license", "apache-2"),
    ("licensed under the apache license version 2", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the "
     "gnu general public license as published by the free software foundation", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
]


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased (null: none)."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAP), lambda w: w != "")


def gram_hashes(w: Column, k: int) -> Column:
    """xxhash64 of every run of ``k`` words."""
    return F.when(F.size(w) >= k, F.transform(
        F.sequence(F.lit(0), F.size(w) - k),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))).otherwise(
            F.array().cast("array<bigint>"))


def template_grams(spark: SparkSession, templates: list[tuple[str, str, bool]], k: int,
                   max_grams: int) -> DataFrame:
    """(hash, gram, template, at, grams): one row per k-gram of a template."""
    short = [t for t, _, _ in templates if len(t.split()) < k]
    if short:
        raise ValueError(f"templates of fewer than {k} words: {short}")
    n = sum(len(t.split()) - k + 1 for t, _, _ in templates)
    if n > max_grams:
        raise ValueError(f"{n} template k-grams; at most {max_grams} may be broadcast")
    rows = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(templates)], "template int, t string")
    return (rows.select("template", words(F.col("t")).alias("tw"))
            .select("template", "tw", F.posexplode(gram_hashes(F.col("tw"), k)).alias("at", "hash"))
            .select("hash", F.slice("tw", F.col("at") + 1, k).alias("gram"), "template", "at",
                    (F.size("tw") - k + 1).alias("grams")))


def votes(docs: DataFrame, grams: DataFrame, k: int, id_col: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows, votes): rows (row, doc_id, n_words); votes (row, template, grams,
    pos, at), one per document place and template position that agree."""
    base = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                        words(F.col(text)).alias("w")))
    rows = base.select("row", "doc_id", F.size("w").cast("long").alias("n_words"))
    hit = (base.select("row", "w", gram_hashes(F.col("w"), k).alias("h"))
           .select("row", "w", F.posexplode("h").alias("pos", "hash"))
           .join(F.broadcast(grams), "hash")
           .filter(F.slice("w", F.col("pos") + 1, k) == F.col("gram"))
           .select("row", "template", "grams", "pos", "at"))
    return rows, hit


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, k: int = 3, max_shift: int = 4,
         min_cover: float = 0.6, max_grams: int = 100_000, id_col: str = "doc_id",
         text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): rows (row, doc_id, n_words) per row of ``docs``; spans
    (row, template, label, is_phrase, begin, end, cover), words from 0, end
    exclusive; phrase spans are exact places."""
    prepare(docs.sparkSession)
    templates = [(t, label, True) for t, label in phrases] + [(t, label, False) for t, label in notices]
    grams = template_grams(docs.sparkSession, templates, k, max_grams)
    rows, hit = votes(stable_input(docs.select(id_col, text), "license-texts"), grams, k, id_col, text)
    # Votes per diagonal; which template positions it holds, as a set. Only texts
    # that share words with a template have any: stored, so that texts are cut and
    # joined once for exact phrases and merged diagonals alike.
    diagonal = (hit.groupBy("row", "template", "grams", (F.col("pos") - F.col("at")).alias("diagonal"))
                .agg(F.min("pos").alias("low"), (F.max("pos") + k).alias("high"),
                     F.collect_set("at").alias("held")))
    diagonal = materialise(diagonal, "license-votes")
    n_phrases = len(phrases)
    exact = (diagonal.filter((F.col("template") < n_phrases) & (F.size("held") == F.col("grams")))
             .select("row", "template", F.col("diagonal").alias("begin"),
                     (F.col("diagonal") + F.col("grams") + k - 1).alias("end"), F.lit(1.0).alias("cover")))
    # Neighbouring diagonals: places of one template at most max_shift words apart.
    place = Window.partitionBy("row", "template").orderBy("low", "diagonal")
    reach = F.max("high").over(place.rowsBetween(Window.unboundedPreceding, -1))
    last = F.lag("diagonal").over(place)
    run = (diagonal.filter(F.col("template") >= n_phrases)
           .withColumn("new", F.coalesce((F.col("low") > reach + max_shift)
                                         | (F.abs(F.col("diagonal") - last) > max_shift), F.lit(True)).cast("int"))
           .withColumn("span", F.sum("new").over(place)))
    merged = (run.groupBy("row", "template", "grams", "span")
              .agg(F.min("low").alias("begin"), F.max("high").alias("end"),
                   F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("n"))
              .withColumn("cover", F.col("n") / F.col("grams"))
              .filter(F.col("cover") >= min_cover)
              .select("row", "template", "begin", "end", "cover"))
    names = F.array(*[F.lit(label) for _, label, _ in templates])
    spans = exact.unionByName(merged).select(
        "row", "template", F.get(names, F.col("template")).alias("label"),
        (F.col("template") < n_phrases).alias("is_phrase"), "begin", "end", "cover")
    return rows, spans


def license_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document row: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score (best cover) and n_spans."""
    rows, spans = scan(docs, **options)
    joined = lambda c: F.concat_ws(",", F.sort_array(F.collect_set(c)))
    base = F.col("is_phrase")
    per_row = spans.groupBy("row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("begin"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("begin"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"), joined("label").alias("labels"),
        F.max("cover").alias("score"), F.count("*").alias("n_spans"))
    zero = F.lit(0).cast("long")
    return (rows.join(per_row, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_base", zero).alias("n_base"), "first_word", "last_word",
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                    F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_spans", zero).alias("n_spans")))
