"""Mixing sources to target weights by Sainte-Lague apportionment.

A document's size is its number of words ``[^\\x20\\x09-\\x0D]+``. Sources in
code point order (null last) weigh ``weights``, repeating, and share ``share``
times all words; a target stops at ``most`` times its source's size and the
excess is shared again by weight (water filling). The total is cut into blocks
of ``block`` words. Blocks go to sources by highest quotients
(target / (2 * seats + 1)), then in the same way from each source to its shards
by shard size, so each shard has an integer quota of blocks. In a shard the
documents stand in seeded order on one tape that is cut into blocks: every
block is taken ``quota div blocks`` times, and a seeded choice of
``quota mod blocks`` blocks once more. A document's share is the words of its
blocks, so never above ``most`` times its size.

Scale: texts are read once and only (id, source, size) goes on. A source has a
shard for every ``shard_rows`` rows, dealt by a hash of the id and the number
of the copy, so a source with a third of all rows spreads over as many tasks
as it needs and each task holds one shard. The apportionments hold one row per
source, or one row per shard of one source (a row per ``shard_rows``
documents).

Edge cases: a null or empty text has size 0 and is never taken; a null source
is a source of its own, last in order; repeated rows are copies that count one
by one; an empty table, or one without words, takes nothing. Equal quotients
go to the earlier source or shard. Other columns are not read. Everything is
seeded: reruns agree.
"""

from __future__ import annotations

import heapq
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm import _text
from shiftwise.llm._io import fresh_names, materialise, prepare


def word_count(text: str) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every whole text (null: 0)."""

    @F.arrow_udf("long")
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            texts = texts.fill_null("").cast(pa.large_string())
            n = [_text.split_words(texts.slice(i, j - i), _text.NONSPACE).counts
                 for i, j in _text.slices(texts)]
            yield pa.array(np.concatenate(n) if n else np.zeros(0, np.int64), pa.int64())

    return words(F.col(text))


def apportion(votes, seats: int, most=None) -> np.ndarray:
    """Sainte-Lague: ``seats`` by highest quotients vote / (2 * won + 1), at
    most ``most`` each; ties go to the earlier party."""
    votes = np.asarray(votes, dtype=np.float64)
    n = len(votes)
    most = np.full(n, seats, dtype=np.int64) if most is None else np.asarray(most, dtype=np.int64)
    won = np.zeros(n, dtype=np.int64)
    live = (votes > 0) & (most > 0)
    # Seats that any run of the quotients hands out: a divisor that is too large.
    while live.any():
        left = seats - won[~live].sum()
        slack = left - live.sum() / 2
        if slack <= 0:
            break
        won[live] = np.floor(votes[live] / (votes[live].sum() / slack) + 0.5).astype(np.int64)
        over = live & (won >= most)
        if not over.any():
            break
        won[over] = most[over]
        live &= ~over
    left = int(seats - won.sum())
    heap = [(-votes[i] / (2 * won[i] + 1), i) for i in np.flatnonzero((votes > 0) & (won < most))]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        won[i] += 1
        left -= 1
        if won[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * won[i] + 1), i))
    return won


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0,
                   shard_rows: int = 4096) -> DataFrame:
    """(source, src, rows, source_size, weight, target, shards) from rows of
    (source, size); one row per source goes through one task."""
    every = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"),
                                        F.count("*").alias("rows"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("src") % len(weights) + 1).cast("int"))
    ranked = (every.withColumn("src", F.row_number().over(place) - 1).withColumn("weight", weight)
              .withColumn("room", F.col("source_size") * float(most))
              .withColumn("level", F.col("room") / F.col("weight")))
    # A source is full when filling all sources to its level takes no more than there is.
    up = Window.orderBy("level", "src")
    all_rows = Window.partitionBy()
    total = F.sum("source_size").over(all_rows) * float(share)
    below = F.coalesce(F.sum("room").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    from_here = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
    full = (ranked.withColumn("total", total)
            .withColumn("full", below + F.col("level") * from_here <= F.col("total")))
    spent = F.sum(F.when(F.col("full"), F.col("room")).otherwise(0.0)).over(all_rows)
    open_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(all_rows)
    return full.select(
        "source", "src", "rows", "source_size", "weight",
        F.when(F.col("full"), F.col("room"))
        .otherwise(F.col("weight") * (F.col("total") - spent) / open_weight).alias("target"),
        F.greatest(F.ceil(F.col("rows") / shard_rows), F.lit(1)).cast("int").alias("shards"))


def _source_quotas(block: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("src")
        seats = int(round(pdf["target"].sum() / block))
        pdf["quota"] = apportion(pdf["target"], seats)
        return pdf[["src", "quota"]]
    return run


def _shard_quotas(block: int, most: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        blocks = -(-pdf["words"] // block)
        pdf["won"] = apportion(pdf["words"], int(pdf["quota"].iloc[0]), int(most) * blocks)
        return pdf[["src", "shard", "won"]]
    return run


def _select_blocks(block: int, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "doc_id", "copy", "size"], kind="stable")
        size = pdf["size"].to_numpy()
        end = np.cumsum(size)
        blocks = -(-int(end[-1]) // block)
        taken = np.zeros(len(pdf), dtype=np.int64)
        if blocks:
            passes, rest = divmod(int(pdf["won"].iloc[0]), blocks)
            rng = np.random.default_rng([seed, int(pdf["src"].iloc[0]), int(pdf["shard"].iloc[0])])
            chosen = np.zeros(blocks + 1, dtype=np.int64)
            chosen[rng.permutation(blocks)[:rest]] = 1
            before = np.concatenate([[0], np.cumsum(chosen[:-1])]) * block
            at = lambda x: before[x // block] + chosen[x // block] * (x % block)
            taken = passes * size + at(end) - at(end - size)
        return pd.DataFrame({"doc_id": pdf["doc_id"], "no_id": pdf["no_id"], "src": pdf["src"], "size": size,
                             "copy": pdf["copy"], "taken": taken})
    return run


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = 8,
        shard_rows: int = 4096, seed: int = 11, id_col: str = "doc_id", text: str = "text",
        source: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, copy (number among equal
    rows), source_size, target, taken."""
    prepare(docs.sparkSession)
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"),
                                   word_count(text).alias("size")), "mix-sizes")
    sources = materialise(source_targets(rows, weights, share, most, shard_rows), "mix-sources")
    quotas = sources.select("src", "target").repartition(1).mapInPandas(
        lambda it: _whole(it, _source_quotas(block), ["src", "quota"]), "src int, quota long")
    # Copies of a row are counted, not carried, through the shuffle, then dealt out one by one.
    copies = rows.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    named = (copies.join(sources.select("source", "src", "shards").withColumnRenamed("source", "s"),
                         F.col("source").eqNullSafe(F.col("s")))
             .select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"),
                     "size", "src", "shards",
                     F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")))
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("copy"))
    dealt = (named.withColumn("order", order)
             .withColumn("shard", F.pmod(F.xxhash64("order", F.lit(seed)), F.col("shards")).cast("int")))
    shards = dealt.groupBy("src", "shard").agg(F.sum("size").cast("long").alias("words"))
    won = (shards.join(quotas, "src").groupBy("src")
           .applyInPandas(_shard_quotas(block, most), "src int, shard int, won long"))
    taken = (dealt.select("doc_id", "no_id", "size", "src", "shard", "copy", "order")
             .join(won, ["src", "shard"]).groupBy("src", "shard").applyInPandas(
                 _select_blocks(block, seed),
                 "doc_id long, no_id boolean, src int, size long, copy long, taken long"))
    return (taken.join(sources.select("src", "source", "source_size", "target"), "src")
            .select(F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "source", "size", "copy", "source_size", "target", "taken"))


def _whole(batches: Iterator[pd.DataFrame], fn, columns: list[str]) -> Iterator[pd.DataFrame]:
    parts = [b for b in batches if len(b)]
    yield fn(pd.concat(parts)) if parts else pd.DataFrame(columns=columns)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with size, source_size, target and taken; documents of which the
    mix takes no word are left out. Those four columns are replaced; all others may
    have any names and types."""
    got = mix(docs, **options)
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    size, key, at = fresh_names(docs, "words", "key", "at")
    digest = F.xxhash64("doc_id", "source", size)
    # Both sides hold the same rows (doc_id, source, size): equal places in equal order meet.
    place = lambda last: Window.partitionBy(key).orderBy("doc_id", "source", size, last)
    left = (docs.select(*own).withColumn(size, word_count("text")).withColumn(key, digest)
            .withColumn(at, F.row_number().over(place("text"))))
    right = (got.withColumnRenamed("size", size).withColumn(key, digest)
             .withColumn(at, F.row_number().over(place("copy")))
             .filter("taken > 0").select(key, at, "source_size", "target", "taken"))
    return left.join(right, [key, at]).select(*own, F.col(size).alias("size"), "source_size", "target", "taken")
