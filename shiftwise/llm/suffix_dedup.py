"""Removal of repeated long strings by suffix arrays.

Every byte of a text (UTF-8) is removed that lies in a string of ``length``
bytes which also starts earlier: in a document with a smaller id, or earlier in
the same one. Matches never cross documents; strings are judged on the input.

1. Buckets. A string of ``length`` bytes belongs to the bucket of its smallest
   ``core``-byte substring by hash (leftmost if equal). That choice depends on
   the string alone, so equal strings meet in one bucket at equal offsets, and
   one row per chosen place stands for the run of strings that chose it (about
   one row per 30 bytes at 100 / 40). Equal runs inside a batch of documents
   are reduced to the first before anything is shuffled.
2. Rows sorted by (bucket, hash of the run's bytes, place) are streamed: a run
   that agrees with an earlier one in the 64-bit hash of its core and in that of
   its whole bytes is a repeat as a whole (its bytes are not compared again; most
   repeats of copied texts are found here, see the README). Buckets with one kind
   of run are done; from others, the first of each kind goes on.
3. The bytes of those runs are fetched (a join on the document's key) and
   grouped by bucket. Many buckets form a block: its runs, the shared core as
   one symbol, are concatenated and their suffixes sorted (``_suffixes``:
   linear, by groups of equal Lyndon prefix). Neighbours in that order that
   agree on a string's length are equal strings, compared symbol by symbol; all
   but the first are repeats.
4. A bucket with more than ``bucket_runs`` kinds of runs is not solved in one
   task: its strings are split by offset in two halves, each of which shares a
   longer core, and dealt again by that core. After at most seven halvings a
   core is the whole string, so this is exact and ends.
5. Repeats are merged per document and the text is cut.

Keys are (doc_id, xxhash64 of the text), so no numbering of rows is relied on
when a lost executor's work runs again. Intermediate results are written to the
shared folder.

Edge cases: a null text is empty; texts shorter than ``length`` keep every
byte; a null id is larger than any other; rows with one id are ordered by the
hash of their text; repeated rows are copies in turn, so all but one lose every
byte (if there are ``length``). Other columns are not read.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm import _text
from shiftwise.llm._io import free_shuffles, materialise, prepare
from shiftwise.llm._suffixes import suffix_array

BLOCK_SYMBOLS = 1 << 15
_POS_BITS = np.uint64(32)

_RUN = pa.schema([("key", pa.int64()), ("ctx", pa.int64()), ("seq", pa.int64()), ("tie", pa.int64()),
                  ("place", pa.int64())])
_SEEN = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("seq", pa.int64()), ("tie", pa.int64()),
                   ("place", pa.int64())])
_DONE = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("seq", pa.int64()), ("tie", pa.int64()),
                   ("place", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("bytes", pa.binary()),
                   ("least", pa.int32()), ("most", pa.int32())])


def _pack(at, o1, o2):
    """Place of a run: core position and offsets of its last and first string
    (a string of offset ``o`` starts ``o`` bytes before the core)."""
    return (at << 15) | (o1 << 8) | (o2 << 1)


def _unpack(place):
    return place >> 15, (place >> 8) & 127, (place >> 1) & 127


# --- 1. buckets -------------------------------------------------------------

def _runs_of_slice(texts: pa.Array, length: int, core: int):
    """(text index, key, ctx, place) of every run of strings in a slice."""
    n_docs = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64, count=n_docs + 1 + texts.offset)[texts.offset:]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    n, w = len(data), length - core + 1
    if n < length:
        return None
    p, q = _text._pow_tables(n + 1)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=run[1:])
    grams = n - core + 1
    h = _text.mix((run[core:] - run[:grams]) * q[:grams])
    keyed = ((h >> _POS_BITS) << _POS_BITS) | np.arange(grams, dtype=np.uint64)
    # Minimum of every w neighbours: from block-wise running minima both ways.
    blocks = np.concatenate([keyed, np.full(-grams % w, 2**64 - 1, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = n - length + 1
    least = (np.minimum(back[:strings], ahead[w - 1:w - 1 + strings])
             & np.uint64(2**32 - 1)).astype(np.int64)
    doc = np.searchsorted(off, np.arange(strings), side="right") - 1
    start = np.flatnonzero(np.arange(strings) + length <= off[doc + 1])
    if not len(start):
        return None
    at = least[start]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[start[1:]] != doc[start[:-1]])]))
    first = start[new]
    last = start[np.append(new[1:], len(start)) - 1]
    at = at[new]
    o1, o2 = at - last, at - first
    low, high = first, last + length
    ctx = _text.mix((run[high] - run[low]) * q[low] + (o1 * 128 + o2).astype(np.uint64))
    own = doc[first]
    return own, h[at].view(np.int64), ctx.view(np.int64), _pack(at - off[own], o1, o2)


def _runs(batches: Iterator[pa.RecordBatch], length: int, core: int) -> Iterator[pa.RecordBatch]:
    """(seq, tie, text) -> runs; a run equal to an earlier one of the batch is
    marked in the lowest bit of ``place``."""
    for batch in batches:
        texts = batch.column("text").cast(pa.large_string())
        seq, tie = batch.column("seq").to_numpy(), batch.column("tie").to_numpy()
        parts = []
        for i, j in _text.slices(texts):
            got = _runs_of_slice(texts.slice(i, j - i), length, core)
            if got is not None:
                parts.append((got[0] + i, *got[1:]))
        if not parts:
            continue
        own, key, ctx, place = (np.concatenate(x) for x in zip(*parts))
        s, t = seq[own], tie[own]
        order = np.lexsort((place, t, s, ctx, key))
        key, ctx, s, t, place = (x[order] for x in (key, ctx, s, t, place))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        copy = ~new & (s == s[first]) & (t == t[first]) & (place == place[first])
        place = place | (~new).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x[~copy]) for x in (key, ctx, s, t, place)], schema=_RUN)


# --- 2. repeats of whole runs -----------------------------------------------

def _first_of_kind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs -> kind 0: repeats, kind 1: the first of each kind of run in
    buckets of several kinds. Holds one row between batches."""
    held, held_many = None, False

    def rows(kind, *columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(columns[0]), kind, np.int8)), *[pa.array(c) for c in columns]], schema=_SEEN)

    for batch in batches:
        key, ctx, seq, tie, place = (batch.column(c).to_numpy() for c in ("key", "ctx", "seq", "tie", "place"))
        known = (place & 1) == 1
        if known.any():
            yield rows(0, key[known], seq[known], tie[known], place[known])
            key, ctx, seq, tie, place = (x[~known] for x in (key, ctx, seq, tie, place))
        if not len(key):
            continue
        if held is not None:
            key, ctx, seq, tie, place = (np.concatenate([[a], x]) for a, x in zip(held, (key, ctx, seq, tie, place)))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])])
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        again = ~new & ((seq != seq[first]) | (tie != tie[first]) | (place != place[first]))
        if again.any():
            yield rows(0, key[again], seq[again], tie[again], place[again])
        f = np.flatnonzero(new)
        same = key[f[1:]] == key[f[:-1]]
        many = np.concatenate([[held_many and held is not None], same])
        many[:-1] |= same
        out, keep = f[:-1][many[:-1]], f[-1]
        if len(out):
            yield rows(1, key[out], seq[out], tie[out], place[out])
        held, held_many = tuple(x[keep] for x in (key, ctx, seq, tie, place)), bool(many[-1])
    if held is not None and held_many:
        yield rows(1, *[np.array([held[i]]) for i in (0, 2, 3, 4)])


# --- 3. suffix arrays of blocks ----------------------------------------------

def _fetch(batches: Iterator[pa.RecordBatch], length: int, core: int) -> Iterator[pa.RecordBatch]:
    """(seq, tie, text, runs) -> the bytes of every run."""
    for batch in batches:
        cols = [[] for _ in range(6)]
        for seq, tie, text, keys, places in zip(*(batch.column(c).to_pylist() for c in (
                "seq", "tie", "text", "keys", "places"))):
            raw = text.encode()
            for key, place in zip(keys, places):
                at, o1, o2 = _unpack(place)
                for c, v in zip(cols, (key, seq, tie, place, raw[at - o2:at - o1 + length], None)):
                    c.append(v)
        n = len(cols[0])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n, 2, np.int8)), *[pa.array(c, pa.int64()) for c in cols[:4]],
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(cols[4], pa.binary()),
            pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, length - core, np.int32))], schema=_DONE)


def solve_block(groups: list[list[tuple]], length: int) -> list[tuple[int, int, int, int]]:
    """Repeated strings among the runs of some buckets, as (seq, tie, low, high).

    A run is (seq, tie, place, bytes, least, most): the strings of offsets
    max(o1, least) to min(o2, most); a bucket's runs stand in text order. The
    bytes shared by all strings of those offsets are one symbol."""
    symbols, starts, owner, offsets, runs = [], [], [], [], []
    cores: dict[tuple, int] = {}
    at_symbol = 0
    for g, group in enumerate(groups):
        for run in group:
            _, _, place, raw, least, most = run
            _, o1, o2 = _unpack(place)
            a, b = max(o1, least), min(o2, most)
            # Offsets a..b: bytes from -b; the core of the class is [-least, length - most).
            lead = o2 - least
            shared = raw[lead:lead + length - (most - least)]
            sign = cores.setdefault((g, shared), 258 + len(cores))
            left, right = raw[o2 - b:lead], raw[lead + len(shared):length + o2 - a]
            s = np.empty(len(left) + len(right) + 2, dtype=np.int64)
            s[:len(left)] = np.frombuffer(left, np.uint8)
            s[:len(left)] += 2
            s[len(left)] = sign
            s[len(left) + 1:-1] = np.frombuffer(right, np.uint8)
            s[len(left) + 1:-1] += 2
            s[-1] = 1
            k = b - a + 1
            starts.append(at_symbol + np.arange(k))
            offsets.append(b - np.arange(k))
            owner.append(np.full(k, len(runs)))
            runs.append(run)
            symbols.append(s)
            at_symbol += len(s)
    symbols.append(np.zeros(1, np.int64))
    text = np.concatenate(symbols)
    begin, owner, offsets = (np.concatenate(x) for x in (starts, owner, offsets))
    least, most = runs[0][4], runs[0][5]
    width = most - least + 1  # symbols of a string: its bytes, the core as one
    string_at = np.full(len(text), -1, dtype=np.int64)
    string_at[begin] = np.arange(len(begin))
    order = string_at[suffix_array(text)]
    order = order[order >= 0]
    if len(order) < 2:
        return []
    span = np.arange(width)
    one, two = begin[order[:-1]][:, None], begin[order[1:]][:, None]
    same = np.concatenate([(text[one[i:i + 8192] + span] == text[two[i:i + 8192] + span]).all(axis=1)
                           for i in range(0, len(one), 8192)])
    new = np.flatnonzero(np.concatenate([[True], ~same]))
    first = np.repeat(np.minimum.reduceat(owner[order], new), np.diff(np.append(new, len(order))))
    repeat = order[owner[order] > first]
    if not len(repeat):
        return []
    by = repeat[np.argsort(owner[repeat], kind="stable")]
    cut = np.flatnonzero(np.concatenate([[True], owner[by[1:]] != owner[by[:-1]]]))
    high_o, low_o = np.maximum.reduceat(offsets[by], cut), np.minimum.reduceat(offsets[by], cut)
    out = []
    for r, ho, lo in zip(owner[by[cut]].tolist(), high_o.tolist(), low_o.tolist()):
        seq, tie, place = runs[r][:3]
        at = place >> 15
        out.append((seq, tie, at - ho, at - lo + length))  # all contain the core: one piece
    return out


def _solve(batches: Iterator[pa.RecordBatch], length: int, bucket_runs: int) -> Iterator[pa.RecordBatch]:
    """Runs sorted by bucket and place -> kind 0: repeats (low, high), kind 2:
    runs of a bucket that is too large, to be dealt again."""
    block: list[list[tuple]] = []
    size, key_now, whole, last = 0, None, None, None
    found: list[tuple] = []
    again: list[tuple] = []

    def flush():
        nonlocal block, size
        if block:
            found.extend(solve_block(block, length))
        block, size = [], 0

    def close(group):
        nonlocal size
        if group and len(group) > 1:
            if block and (block[0][0][4], block[0][0][5]) != (group[0][4], group[0][5]):
                flush()
            block.append(group)
            size += sum(len(r[3]) for r in group)
            if size >= BLOCK_SYMBOLS:
                flush()

    def emit():
        nonlocal found, again
        n, m = len(found), len(again)
        col = lambda rows, i, kind: pa.array([r[i] for r in rows], kind)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.zeros(n, np.int8)), pa.nulls(n, pa.int64()), col(found, 0, pa.int64()),
                col(found, 1, pa.int64()), pa.nulls(n, pa.int64()), col(found, 2, pa.int64()),
                col(found, 3, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int32()),
                pa.nulls(n, pa.int32())], schema=_DONE)
        if m:
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, 2, np.int8)), pa.nulls(m, pa.int64()), col(again, 0, pa.int64()),
                col(again, 1, pa.int64()), col(again, 2, pa.int64()), pa.nulls(m, pa.int64()),
                pa.nulls(m, pa.int64()), col(again, 3, pa.binary()), col(again, 4, pa.int32()),
                col(again, 5, pa.int32())], schema=_DONE)
        found, again = [], []

    group: list[tuple] | None = []  # None: the bucket overflowed
    for batch in batches:
        for key, *run in zip(*(batch.column(c).to_pylist() for c in (
                "key", "seq", "tie", "place", "bytes", "least", "most"))):
            run = tuple(run)
            if key != key_now:
                close(group)
                key_now, group, whole, last = key, [], None, None
            if run[:3] == last:  # fetched for a repeated row as well
                continue
            last = run[:3]
            if run[4] == run[5]:  # the core is the string: equal to the first or a false friend
                at, _, _ = _unpack(run[2])
                raw = _string(run, length)
                if whole is None:
                    whole = {}
                if raw in whole:
                    found.append((run[0], run[1], at - run[4], at - run[4] + length))
                else:
                    whole[raw] = True
                continue
            if group is None:
                again.append(run)
                continue
            group.append(run)
            if len(group) > bucket_runs:
                again.extend(group)
                group = None
        yield from emit()
    close(group)
    flush()
    yield from emit()


def _string(run, length: int) -> bytes:
    _, _, o2 = _unpack(run[2])
    return run[3][o2 - run[4]:o2 - run[4] + length]


def _deal_again(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Halve the offsets of every run's class; the key is the half's core."""
    for batch in batches:
        rows = []
        for seq, tie, place, raw, least, most in zip(*(batch.column(c).to_pylist() for c in (
                "seq", "tie", "place", "bytes", "least", "most"))):
            _, o1, o2 = _unpack(place)
            middle = (least + most) // 2
            for a, b in ((least, middle), (middle + 1, most)):
                if max(o1, a) <= min(o2, b):
                    shared = raw[o2 - a:o2 - b + length]
                    digest = hashlib.blake2b(shared + bytes([a, b]), digest_size=8).digest()
                    rows.append((int.from_bytes(digest, "little", signed=True), seq, tie, place, raw, a, b))
        n = len(rows)
        c = list(zip(*rows)) if rows else [[]] * 7
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n, 2, np.int8)), *[pa.array(c[i], pa.int64()) for i in range(4)],
            pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(c[4], pa.binary()),
            pa.array(c[5], pa.int32()), pa.array(c[6], pa.int32())], schema=_DONE)


# --- 5. cutting ----------------------------------------------------------------

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.string())])


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            if high > out[-1][1]:
                out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, copy, lows, highs in zip(*(batch.column(c).to_pylist() for c in (
                "doc_id", "text", "copy", "lows", "highs"))):
            raw = text.encode()
            spans = merge(list(zip(lows or (), highs or ())))
            if copy > 1 and len(raw) >= length:
                spans = [(0, len(raw))]
            kept, at = hashlib.sha256(), 0
            for low, high in spans:
                kept.update(raw[at:low])
                at = high
            kept.update(raw[at:])
            rows.append((doc_id, len(raw), sum(b - a for a, b in spans), len(spans), kept.hexdigest(),
                         ",".join(f"{a}:{b}" for a, b in spans)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
            zip(*rows) if rows else [[]] * len(_OUT), _OUT)], schema=_OUT)


def remove_repeats(docs: DataFrame, length: int = 100, core: int = 40, bucket_runs: int = 8192,
                   id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, spans (start:end of removed runs in bytes, comma-joined)."""
    if not 8 <= core < length <= core + 127:
        raise ValueError("core must be at least 8 bytes and within 127 bytes of length")
    spark = docs.sparkSession
    prepare(spark)
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("seq"),
                       F.xxhash64(t).alias("tie"), t.alias("text"))
    runs = (rows.filter(F.octet_length("text") >= length).select("seq", "tie", "text")
            .mapInArrow(lambda it: _runs(it, length, core),
                        "key long, ctx long, seq long, tie long, place long"))
    # Known repeats only pass through: they are spread by document, not by bucket.
    known = F.col("place").bitwiseAND(F.lit(1)) == 1
    sorted_runs = (runs.withColumn("route", F.when(known, F.xxhash64("seq", "tie", "place")).otherwise(F.col("key")))
                   .repartition("route").sortWithinPartitions("key", "ctx", "seq", "tie", "place").drop("route"))
    seen = materialise(sorted_runs.mapInArrow(
        _first_of_kind, "kind byte, key long, seq long, tie long, place long"), "suffix-runs")
    free_shuffles(spark)
    at, o1, o2 = (F.shiftright("place", 15), F.shiftright("place", 8).bitwiseAND(F.lit(127)),
                  F.shiftright("place", 1).bitwiseAND(F.lit(127)))
    repeats = [seen.filter("kind = 0").select("seq", "tie", (at - o2).alias("low"), (at - o1 + length).alias("high"))]

    wanted = (seen.filter("kind = 1").groupBy("seq", "tie")
              .agg(F.collect_list(F.struct("key", "place")).alias("runs"))
              .select("seq", "tie", F.col("runs.key").alias("keys"), F.col("runs.place").alias("places")))
    done = "kind byte, key long, seq long, tie long, place long, low long, high long, bytes binary, least int, most int"
    # Repeated rows fetch the same bytes again: one of them is enough.
    dealt = (rows.select("seq", "tie", "text").join(wanted, ["seq", "tie"]).mapInArrow(lambda it: _fetch(it, length, core), done))
    while True:
        solved = materialise(
            dealt.repartition("key").sortWithinPartitions("key", "seq", "tie", "place")
            .mapInArrow(lambda it: _solve(it, length, bucket_runs), done), "suffix-blocks")
        free_shuffles(spark)
        repeats.append(solved.filter("kind = 0").select("seq", "tie", "low", "high"))
        over = solved.filter("kind = 2")
        if over.isEmpty():
            break
        dealt = over.mapInArrow(lambda it: _deal_again(it, length), done)

    every = repeats[0]
    for r in repeats[1:]:
        every = every.unionByName(r)
    spans = (every.groupBy("seq", "tie").agg(F.collect_list(F.struct("low", "high")).alias("s"))
             .select("seq", "tie", F.col("s.low").alias("lows"), F.col("s.high").alias("highs")))
    copy = F.row_number().over(Window.partitionBy("seq", "tie").orderBy("seq"))
    return (rows.join(spans, ["seq", "tie"], "left").withColumn("copy", copy)
            .select("doc_id", "text", "copy", "lows", "highs")
            .mapInArrow(lambda it: _cut(it, length), "doc_id long, n_bytes long, n_removed long, "
                        "n_spans long, kept_sha256 string, spans string"))
