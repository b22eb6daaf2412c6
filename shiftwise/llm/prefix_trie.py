"""Trie of conversation prefixes, built by cutting sequences at half depth.

A van Emde Boas layout cuts a trie of height 2h into one upper trie of height h
and a forest of lower tries that hang below the cut, and treats all of them
alike. Here a turn is a token (a digest of role and text, and the text's
length), a conversation a sequence of tokens, and a node the prefix that leads
to it.

1. Rank. Turns are range-partitioned by (conversation, turn), stored, and ranked
   by a count per partition and an order inside it, so a conversation that holds
   a third of all turns is ranked by many tasks. Texts are hashed in the scan and
   never shuffled.
2. Cut. Sequences are cut every ``BLOCK`` = 64 turns. Blocks are named by their
   tokens, a conversation's block names form a shorter sequence, and so on until
   no sequence is longer than 64: each level is the upper trie of the one below,
   and no row ever holds more than 64 entries. Going down again, every block
   learns the name of the prefix it hangs below. Inside a block ``prefix_names``
   halves: the cut prefix gets a name from its root and its tokens, then the
   upper half (same root) and the lower half (the cut prefix as root) are cut in
   turn. All blocks of all conversations are cut in parallel; equal ones (same
   root, same tokens) are merged before.
3. Graft. A node at depth d of its block stands below an upper trie of height
   h = lowest set bit of d. Starting from each node's children, the totals of the
   lower tries of height h = 1, 2, 4 .. 32 are added to the h nodes of the upper
   trie above their root. That completes every block; then blocks are the nodes
   of the next level's trie, whose totals are formed in the same way, and come
   back down to the turns of the block above. A path of n turns costs about
   (n / 2) log n additions, not n squared.

Names are SHA-256 digests of (root, tokens): two prefixes have one name exactly
when their turns agree (but for SHA-256 collisions).

Edge cases. Turns of one conversation are ordered by turn, null first; equal
turns by role and text digest; repeated rows are turns of their own. A null role
or text is empty. A row whose conversation id is null belongs to none and is left
out. Ids may be negative; ``%`` has the sign of the id. An empty table has no
members, and so not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import partial
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm._io import materialise, prepare

BLOCK = 64
ROOT = hashlib.sha256(b"root").digest()
#: Ids per piece of a node's member list: a piece holds at most so many distinct ids.
MEMBERS = 1024
SALTS = 8

NODES = pa.schema([
    ("name", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("at", pa.int32()),
    ("above", pa.list_(pa.binary())), ("chars", pa.int64()), ("n", pa.int64()), ("first", pa.int64())])
PATHS = pa.schema([("conv", pa.int64()), ("pos", pa.int64()), ("name", pa.binary()), ("parent", pa.binary()),
                   ("at", pa.int32()), ("above", pa.list_(pa.binary()))])
PATHS_DDL = "conv long, pos long, name binary, parent binary, at int, above array<binary>"
NODES_DDL = ("name binary, parent binary, depth long, at int, above array<binary>, chars long, n long, first long")


# --- names inside one block ---------------------------------------------------------------

def _name(root: bytes, tokens: list[bytes]) -> bytes:
    return hashlib.sha256(root + b"".join(tokens)).digest()


def prefix_names(root: bytes, tokens: list[bytes], height: int) -> list[bytes]:
    """Names of the prefixes of 1, 2, .. tokens below ``root``; ``height`` is a
    power of two that is at least ``len(tokens)``."""
    if not tokens:
        return []
    half = height // 2
    if height == 1:
        return [_name(root, tokens)]
    if len(tokens) < half:
        return prefix_names(root, tokens, half)
    cut = _name(root, tokens[:half])
    upper = prefix_names(root, tokens[:half], half)
    lower = tokens[half:]
    if len(lower) < half:
        return [*upper[:-1], cut, *prefix_names(cut, lower, half)]
    whole = _name(root, tokens)  # a prefix that fills the block is named from the block's root
    return [*upper[:-1], cut, *prefix_names(cut, lower, half)[:-1], whole]


# --- turns and their ranks ----------------------------------------------------------------

def turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, token, chars): one row per turn, texts reduced to digests."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    token = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    return (conversations.filter(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), token.alias("token"),
                    F.char_length(text).cast("long").alias("chars")))


def ranked(rows: DataFrame) -> DataFrame:
    """(conv, pos from 1, token, chars): the order of each conversation's turns."""
    order = [F.asc_nulls_first("turn"), F.asc("token"), F.asc("__row")]
    dealt = (rows.withColumn("__row", F.monotonically_increasing_id())
             .repartitionByRange(F.asc("conv"), *order).withColumn("__part", F.spark_partition_id()))
    stored = materialise(dealt, "trie-turns")
    counts = stored.groupBy("conv", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("conv").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("conv", "__part").orderBy(*order))
    return (stored.withColumn("__at", inside).join(offsets, ["conv", "__part"])
            .select("conv", (F.col("__before") + F.col("__at")).alias("pos"), "token", "chars"))


def head_length(conv: Column) -> Column:
    """How many turns of its base a conversation starts with (0 to 5)."""
    return (F.crc32(conv.cast("string").cast("binary")) % 6).cast("long")


def rebuilt(rank: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): each conversation begins with the first turns of its base
    (the id without its last two digits), followed by its own behind those."""
    convs = rank.groupBy("conv").agg(F.max("pos").alias("own")).withColumn("h", head_length(F.col("conv")))
    convs = convs.withColumn("base", F.col("conv") - F.col("conv") % 100)
    heads = rank.filter("pos <= 5 and conv % 100 = 0").select(
        F.col("conv").alias("base"), F.col("pos"), F.col("token"), F.col("chars"))
    had = heads.groupBy("base").agg(F.max("pos").alias("base_n"))
    convs = (convs.join(had, "base", "left")
             .withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))).drop("base_n"))
    start = convs.filter("head > 0").join(heads, "base").filter("pos <= head").select("conv", "pos", "token", "chars")
    tail = (rank.join(convs.select("conv", "h", "head"), "conv").filter("pos > h")
            .select("conv", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "token", "chars"))
    lengths = convs.select("conv", (F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return start.unionByName(tail), lengths


# --- blocks -------------------------------------------------------------------------------

def _blocks(entries: DataFrame, size: int) -> DataFrame:
    """(conv, block, tokens, chars): at most ``size`` entries a row, in order."""
    block = F.floor((F.col("pos") - 1) / size).cast("long")
    return (entries.groupBy("conv", block.alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", "token", "chars"))).alias("e"))
            .select("conv", "block", F.col("e.token").alias("tokens"), F.col("e.chars").alias("chars")))


def _placed(entries: DataFrame, longest: int, size: int, level: int = 0) -> tuple[DataFrame, list[DataFrame]]:
    """(blocks, upper levels). Blocks carry the name of the prefix they hang below
    (``root``) and, where longer sequences exist, full ones that of the prefix they
    end at (``end``). An upper level is the table of the block ends of the level
    below it: name, parent, at, above."""
    blocks = materialise(_blocks(entries, size), f"trie-blocks-{level}")
    if longest <= size:
        return blocks.withColumn("root", F.lit(ROOT)).withColumn("end", F.lit(None).cast("binary")), []
    named = blocks.filter(F.size("tokens") == size).select(
        "conv", (F.col("block") + 1).alias("pos"),
        F.unhex(F.sha2(F.reduce("tokens", F.lit(b""), lambda a, t: F.concat(a, t)), 256)).alias("token"),
        F.lit(0).cast("long").alias("chars"))
    upper, levels = _placed(named, longest // size, size, level + 1)
    paths = materialise(upper.mapInArrow(partial(_paths, size=size), PATHS_DDL), f"trie-paths-{level}")
    starts = paths.select("conv", F.col("pos").alias("block"), F.col("name").alias("root"))
    stops = paths.select("conv", (F.col("pos") - 1).alias("block"), F.col("name").alias("end"))
    placed = (blocks.join(starts, ["conv", "block"], "left").join(stops, ["conv", "block"], "left")
              .withColumn("root", F.coalesce("root", F.lit(ROOT))))
    ends = paths.groupBy("name").agg(*[F.any_value(c).alias(c) for c in ("parent", "at", "above")])
    return placed, [ends, *levels]


def _path(row: dict, size: int) -> list[bytes]:
    """Names from a block's root to its last turn."""
    names = prefix_names(row["root"], row["tokens"], size)
    if row["end"] is not None:
        names[-1] = row["end"]
    return [row["root"], *names]


def _above(path: list[bytes], at: int, size: int) -> list[bytes]:
    """The nodes of the upper trie whose totals the node at depth ``at`` completes:
    at a block's end, those of the whole block but for its root."""
    return path[1:at] if at == size else path[at - (at & -at):at]


def _paths(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The prefixes of every block of an upper level, conversation by conversation."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            path = _path(row, size)
            out += [{"conv": row["conv"], "pos": row["block"] * size + i, "name": path[i], "parent": path[i - 1],
                     "at": i, "above": _above(path, i, size)} for i in range(1, len(path))]
        yield pa.RecordBatch.from_pylist(out, PATHS)


def _grow(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The nodes of every block."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            path = _path(row, size)
            out += [{"name": path[i], "parent": path[i - 1], "depth": row["block"] * size + i, "at": i,
                     "above": _above(path, i, size), "chars": row["chars"][i - 1], "n": row["n"], "first": row["first"]}
                    for i in range(1, len(path))]
        yield pa.RecordBatch.from_pylist(out, NODES)


def _last_names(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["conv"] for row in rows], pa.int64()),
             pa.array([_path(row, size)[-1] for row in rows], pa.binary())], names=["conv", "name"])


# --- totals -------------------------------------------------------------------------------

PAIR = "struct<name:binary,leaves:bigint,saved:bigint,at:int,above:array<binary>>"


def _give(to: Column, leaves: Column, saved: Column, at: Column | None = None, above: Column | None = None) -> Column:
    null = F.lit(None)
    return F.struct(to, leaves, saved, null if at is None else at, null if above is None else above).cast(PAIR)


def _summed(nodes: DataFrame, gifts: Column) -> DataFrame:
    """Each node's own totals plus the gifts of others, by name."""
    own = F.array(_give(F.col("name"), F.col("leaves"), F.col("saved"), F.col("at"), F.col("above")))
    rows = nodes.select(F.inline(F.concat(own, F.coalesce(gifts, F.array().cast(f"array<{PAIR}>")))))
    return rows.groupBy("name").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("at").alias("at"),
        F.any_value("above", True).alias("above"))


def graft(nodes: DataFrame, levels: list[DataFrame], longest: int, size: int) -> DataFrame:
    """(name, leaves, saved): sums over the nodes properly below each node, from
    nodes (name, parent, at, above, leaves, saved) and the upper levels."""
    zero, tag = F.lit(0).cast("long"), len(levels)
    state = nodes.select(F.inline(F.array(_give(F.col("name"), zero, zero, F.col("at"), F.col("above")),
                                          _give(F.col("parent"), F.col("leaves"), F.col("saved")))))
    state = state.groupBy("name").agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("at").alias("at"),
        F.any_value("above", True).alias("above"))
    everyone = F.transform("above", lambda a: _give(a, F.col("leaves"), F.col("saved")))
    height = 1
    while height < min(longest, size):
        state = _summed(state, F.when(F.col("at").bitwiseAND(F.lit(2 * height - 1)) == height, everyone))
        height *= 2
        if height in (8, size):
            state = materialise(state, f"trie-graft-{tag}-{height}")
    if not levels:
        return state.select("name", "leaves", "saved")
    totals = state.select("name", "leaves", "saved")
    below = graft(levels[0].join(totals, "name"), levels[1:], longest // size, size)
    whole = state.join(below.withColumnsRenamed({"leaves": "l", "saved": "s"}), "name", "left").select(
        "name", (F.col("leaves") + F.coalesce("l", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("s", zero)).alias("saved"), "at", "above")
    return _summed(whole, F.when(F.col("at") == size, everyone)).select("name", "leaves", "saved")


# --- members ------------------------------------------------------------------------------

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each name, which arrive in order: the hash runs on
    over batches, so a list of any length is never held."""
    name, state = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])],
                                          names=["name", "ends_sha256"])

    for batch in batches:
        for key, text in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
            if key != name:
                if state is not None:
                    yield done()
                name, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state is not None:
        yield done()


def member_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of the conversations (conv, name) that end at a node. Ids
    are joined in pieces of at most ``MEMBERS`` neighbouring ids before they meet."""
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    pieces = (ends.groupBy("name", F.floor(F.col("conv") / MEMBERS).alias("piece"))
              .agg(F.array_join(ids, ",").alias("ids")))
    ordered = pieces.repartition("name").sortWithinPartitions("name", "piece")
    return ordered.mapInArrow(_digests, "name binary, ends_sha256 string")


# --- the trie -----------------------------------------------------------------------------

def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. ``block`` (a power of two, at
    least 2) bounds the turns that one row holds."""
    if block < 2 or block & (block - 1):
        raise ValueError("block must be a power of two, at least 2")
    prepare(conversations.sparkSession)
    rank = materialise(ranked(turns(conversations)), "trie-ranks")
    entries, lengths = rebuilt(rank)
    lengths = materialise(lengths, "trie-lengths")
    longest = lengths.agg(F.max("length")).first()[0] or 0
    placed, levels = _placed(entries, max(longest, 1), block)
    placed = materialise(placed, "trie-placed") if levels else placed

    merged = placed.groupBy("root", "end", "block", "tokens", "chars").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"))
    grown = merged.mapInArrow(partial(_grow, size=block), NODES_DDL).groupBy("name").agg(
        *[F.any_value(c).alias(c) for c in ("parent", "depth", "at", "above", "chars")],
        F.sum("n").alias("n"), F.min("first").alias("first"))
    nodes = materialise(grown, "trie-nodes")
    root = lengths.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("first")).filter("n > 0").select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("int").alias("at"), F.lit(None).cast("array<binary>").alias("above"),
        F.lit(0).cast("long").alias("chars"), "n", "first")
    kids = nodes.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("kids"))
    every = (nodes.unionByName(root).join(kids, "name", "left")
             .withColumn("kids", F.coalesce("kids", F.lit(0).cast("long")))
             .withColumn("leaves", (F.col("kids") == 0).cast("long"))
             .withColumn("saved", (F.col("n") - 1) * F.col("chars")))
    every = materialise(every, "trie-every")
    below = graft(every.filter("parent is not null").select("name", "parent", "at", "above", "leaves", "saved"),
                  levels, longest, block)

    last = placed.join(lengths, "conv").filter(F.col("block") == F.floor((F.col("length") - 1) / block))
    ends = last.select("conv", "root", "end", "block", "tokens").mapInArrow(partial(_last_names, size=block), "conv long, name binary")
    ends = ends.unionByName(lengths.filter("length = 0").select("conv", F.lit(ROOT).alias("name")))

    # A parent of very many children is met by its copies, one for each salt.
    parents = every.filter("kids > 0").select(
        F.col("name").alias("parent"), F.col("first").alias("parent_conv_id"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    none = hashlib.sha256(b"").hexdigest()
    out = (every.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int"))
           .join(parents, ["parent", "salt"], "left")
           .join(below.withColumnsRenamed({"leaves": "l", "saved": "s"}), "name", "left")
           .join(member_digests(ends), "name", "left"))
    return out.select(
        F.col("first").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
        (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
