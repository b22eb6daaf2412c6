"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased,
shingles of ``shingle`` words joined by one space (repeats included; a shorter
text is one shingle; no words: fingerprint 0), XXH64 (seed 42) of each, and a
bit is 1 when set in more than half of the hashes.

Two fingerprints link when they differ in at most ``radius`` bits. Candidates
come from ``2^(radius+1) - 1`` bit masks: every bit gets a non-zero vector of
``radius + 1`` bits, and mask ``v`` keeps the bits whose vector has an odd
product with ``v``. For any ``radius`` differing bits some ``v`` is orthogonal
to all of their vectors, so that pair agrees on everything mask ``v`` keeps: no
pair within the radius is missed.

Plan: documents are reduced to distinct fingerprints first, so copies cost one
row. Each fingerprint goes to one bucket per mask (one shuffle). A bucket is
streamed in sorted order; its members are linked to their component inside the
bucket (at most members - 1 links, never all pairs). A bucket of more than
``bucket_rows`` members is not solved in one task: its members are dealt again
by the masks of a covering of the bits the first mask left open, which is exact
for the same reason; open bits halve with every level, and a bucket with at most
``CLOSED_BITS`` open bits cannot be large. Components are then found by
alternating large-star and small-star rounds, each written to the shared
folder.

Edge cases: null text is an empty text; repeated rows and equal texts share a
fingerprint; a null ``doc_id`` never is a component id unless its whole group
has none (then the id is null). Other columns of ``docs`` are not read.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm import _text
from shiftwise.llm._io import fresh_names, materialise, prepare, sortable

BITS = 64
CLOSED_BITS = 8  # a bucket with this many open bits has at most 256 members


# --- fingerprints ---------------------------------------------------------

def fingerprints(texts: pa.Array, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """uint64 fingerprint of every text of an Arrow array."""
    texts = texts.fill_null("").cast(pa.large_string())
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, j in _text.slices(texts):
        w = _text.split_words(texts.slice(i, j - i), _text.NONSPACE)
        if not len(w.start):
            continue
        # Words of a text joined by exactly one space.
        gap = w.start - 1
        gap = np.delete(gap, w.first[:-1][w.counts > 0])
        keep = w.data != 0x20
        keep[gap] = True
        at = np.concatenate([[0], np.cumsum(keep)])
        data = w.data[keep].tobytes()
        counts = w.counts
        n_grams = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
        owner = np.repeat(np.arange(len(counts)), n_grams)
        begin_gram = np.concatenate([[0], np.cumsum(n_grams)])
        word = w.first[owner] + np.arange(len(owner)) - begin_gram[owner]
        last = np.minimum(word + shingle, w.first[owner + 1]) - 1
        spans = zip(at[w.start[word]].tolist(), at[w.end[last]].tolist())
        h = np.fromiter((digest(data[a:b], seed) for a, b in spans), dtype=np.uint64, count=len(owner))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = np.flatnonzero(counts)
        ones = np.add.reduceat(bits, begin_gram[full], axis=0, dtype=np.int32)
        major = (2 * ones > n_grams[full][:, None]).astype(np.uint8)
        out[i + full] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprint(text: str, shingle: int = 3) -> Column:
    """The fingerprint as a signed 64-bit column (same bits)."""

    @F.arrow_udf("long")
    def simhash(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(fingerprints(texts, shingle).view(np.int64), pa.int64())

    return simhash(F.col(text))


def as_hex(c: Column) -> Column:
    return F.lower(F.lpad(F.hex(c), 16, "0"))


# --- covering masks -------------------------------------------------------

def covering_masks(radius: int, open_bits: int = 2**BITS - 1) -> list[int]:
    """Masks over ``open_bits`` so that any ``radius`` of them are all dropped
    by at least one mask."""
    size = radius + 1
    positions = [i for i in range(BITS) if open_bits >> i & 1]
    vectors = [1 + n % (2**size - 1) for n in range(len(positions))]
    return [sum(1 << i for i, m in zip(positions, vectors) if (v & m).bit_count() % 2)
            for v in range(1, 2**size)]


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _near(fp: np.ndarray, radius: int) -> np.ndarray:
    """Label (smallest index) of every fingerprint's component in a bucket."""
    n = len(fp)
    adj = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    label = np.arange(n)
    while True:
        new = np.where(adj, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _bucket_links(rows: Iterator[pa.RecordBatch], radius: int, bucket_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted (mask, key, fp) rows -> links (fp, other) inside every bucket of at
    most ``bucket_rows`` members; members of larger buckets come out as
    (fp, mask) rows to be dealt again. Holds one bucket at most."""
    schema = pa.schema([("fp", pa.int64()), ("other", pa.int64()), ("mask", pa.int64())])

    def solve(fp: np.ndarray):
        if len(fp) < 2:
            return [], []
        if len(fp) == 2:
            near = (int(fp[0]) ^ int(fp[1])).bit_count() <= radius
            return ([int(fp[1:].view(np.int64)[0])], [int(fp.view(np.int64)[0])]) if near else ([], [])
        label, s = _near(fp, radius), fp.view(np.int64)
        linked = np.flatnonzero(label != np.arange(len(fp)))
        return s[linked].tolist(), s[label[linked]].tolist()

    held_key, held, spilled = None, [], False
    for batch in rows:
        a, b, out_mask = [], [], []
        mask, key = batch.column("mask").to_numpy(), batch.column("key").to_numpy()
        fp = batch.column("fp").to_numpy()
        if not len(fp):
            continue
        edge = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
        bounds = np.concatenate([[0], edge, [len(fp)]])
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            this = (int(mask[s]), int(key[s]))
            if this != held_key:
                if held_key is not None and not spilled and sum(map(len, held)) > 1:
                    x, y = solve(np.concatenate(held).view(np.uint64))
                    a += x
                    b += y
                    out_mask += [None] * len(x)
                held_key, held, spilled = this, [], False
            held.append(fp[s:e])
            # With few bits left open a bucket is small whatever the data.
            if spilled or (sum(map(len, held)) > bucket_rows
                           and BITS - (this[0] & (2**BITS - 1)).bit_count() > CLOSED_BITS):
                spilled = True
                again = np.concatenate(held).tolist()
                a += again
                b += [None] * len(again)
                out_mask += [this[0]] * len(again)
                held = []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                              pa.array(out_mask, pa.int64())], schema=schema)
    if held_key is not None and not spilled and sum(map(len, held)) > 1:
        x, y = solve(np.concatenate(held).view(np.uint64))
        if x:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()),
                                              pa.array([None] * len(x), pa.int64())], schema=schema)


def covering_links(prints: DataFrame, radius: int = 3, bucket_rows: int = 1024) -> DataFrame:
    """Links (fp, other) that connect all pairs of distinct fingerprints of
    ``prints.fp`` within ``radius`` bits (transitively, inside each bucket)."""

    options = F.array(*[F.lit(_signed(m)) for m in covering_masks(radius)])
    dealt = (prints.select("fp", F.explode(options).alias("mask"))
             .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
    out = None
    while True:
        found = materialise(
            dealt.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
            .mapInArrow(lambda it: _bucket_links(it, radius, bucket_rows),
                        "fp long, other long, mask long"), "simhash-links")
        links = found.filter("other is not null").select("fp", "other")
        out = links if out is None else out.unionByName(links)
        again = found.filter("other is null").select("fp", "mask").distinct()
        if again.isEmpty():
            return out
        dealt = again.mapInArrow(lambda it: _deal_again(it, radius), "mask long, key long, fp long")


def _deal_again(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """(fp, mask) rows of buckets that were too large -> one row per mask of a
    covering of the bits ``mask`` leaves open (added to ``mask``)."""
    finer: dict[int, np.ndarray] = {}
    for batch in batches:
        fp, mask = (batch.column(c).to_numpy().view(np.uint64) for c in ("fp", "mask"))
        for m in np.unique(mask):
            if int(m) not in finer:
                open_bits = ~int(m) & (2**BITS - 1)
                masks = sorted({int(m) | sub for sub in covering_masks(radius, open_bits)})
                finer[int(m)] = np.array(masks, dtype=np.uint64)
            own = fp[mask == m]
            masks = np.repeat(finer[int(m)], len(own))
            prints = np.tile(own, len(finer[int(m)]))
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (masks, prints & masks, prints)],
                                             names=["mask", "key", "fp"])


# --- components -----------------------------------------------------------

def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``links``
    (columns fp, other). Alternating large-star / small-star rounds."""
    edges = materialise(
        links.filter("fp <> other")
        .select(F.greatest("fp", "other").alias("u"), F.least("fp", "other").alias("v")).distinct(),
        "components")

    def signature(e: DataFrame):
        r = e.agg(F.count("*").alias("n"),
                  F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40))).alias("s")).first()
        return r["n"], r["s"]

    before = signature(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        # Small star: link the smaller neighbours of a node, and itself, to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = materialise(small, "components")
        now = signature(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


# --- operator -------------------------------------------------------------

def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text: str = "text", bucket_rows: int = 1024) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (smallest id reachable over links), group_print (one
    fingerprint that names the component) and group_rows (its rows)."""
    prepare(docs.sparkSession)
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), fingerprint(text, shingle).alias("fp")),
                       "simhash-prints")
    prints = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")),
                         "simhash-distinct")
    comp = components(covering_links(prints, radius, bucket_rows))
    rooted = (prints.join(comp, prints["fp"] == comp["node"], "left")
              .select("fp", "low", "n", F.coalesce("root", "fp").alias("root")))
    roots = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.sum("n").alias("group_rows"))
    named = rooted.join(roots, "root").select(
        "fp", "component_id", as_hex(F.col("root")).alias("group_print"), "group_rows")
    return (rows.join(named, "fp")
            .select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id",
                    "group_print", "group_rows"))


def keep_one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, also where groups share
    an id: the least of the group's rows with its smallest doc_id (of all its
    rows, if none has an id), by text hash, then all columns. The columns of
    ``docs`` may have any names and types."""
    found = near_duplicates(docs, shingle, radius)
    own, key, print_, group, place = fresh_names(docs, "print", "key", "first_print", "group", "place")
    first = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .select(F.col("doc_id").alias(key), F.col("fingerprint").alias(print_),
                     F.col("group_print").alias(group)).distinct())
    printed = docs.withColumn(own, as_hex(fingerprint("text", shingle)))
    met = printed.join(first, (F.col(own) == F.col(print_)) & F.col("doc_id").eqNullSafe(F.col(key)))
    # row_number = 1 is limited in every task before the shuffle: copies do not meet.
    order = Window.partitionBy(group).orderBy(F.sha2(F.coalesce("text", F.lit("")), 256), *sortable(docs))
    return (met.withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
