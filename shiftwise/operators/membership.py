"""Set-membership filter: which rows of a large table can have a partner in a
smaller one, decided in the scan, before anything is shuffled.

The keys of the smaller side set bits of a Bloom filter: ``HASHES`` positions per
key, or-ed together by a grouped aggregation into 64-bit words (combined
map-side) and gathered into one array. The filter has a fixed number of bits
however many keys there are, so what every task receives is bounded; more keys
only let more strangers through. A row of the large side passes when all its
bits are set: a row with a partner always passes, of the others about
``(1 - exp(-HASHES * keys / bits)) ** HASHES``.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftwise.operators._checks import input_bytes, require_keys

HASHES = 4
MIN_BITS, MAX_BITS = 1 << 13, 1 << 26  # 1 KiB to 8 MiB
#: Types whose equal values have equal hashes (floating point has two zeros).
HASHABLE = ("tinyint", "smallint", "int", "bigint", "string", "date", "timestamp", "timestamp_ntz", "boolean",
            "binary", "decimal")


def filter_bits(stage: DataFrame, bytes_per_key: int = 16, bits_per_key: int = 10) -> int:
    """A filter size for ``stage`` from what the planner knows of its input (no job):
    a power of two between ``MIN_BITS`` and ``MAX_BITS``."""
    wanted = max(1, input_bytes(stage) // bytes_per_key) * bits_per_key
    return max(MIN_BITS, min(MAX_BITS, 1 << (int(wanted) - 1).bit_length()))


def can_filter(left: DataFrame, right: DataFrame, keys: Sequence[str],
               names: Mapping[str, str] | None = None) -> bool:
    """Whether key columns hash alike on both sides (same types, and such as allow it)."""
    names, lt, rt = dict(names or {}), dict(left.dtypes), dict(right.dtypes)
    return all(lt[k] == rt[names.get(k, k)] and lt[k].split("(")[0] in HASHABLE for k in keys)


def _positions(keys: Sequence[Column], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(bits)) for i in range(HASHES)]


def key_filter(stage: DataFrame, keys: Sequence[str], names: Mapping[str, str] | None = None,
               bits: int | None = None) -> DataFrame:
    """One row, one column ``words``: the filter of ``stage``'s keys (rows with a NULL
    key have no partner and set no bit)."""
    names, keys = dict(names or {}), require_keys(keys)
    bits = bits or filter_bits(stage)
    if bits % 64:
        raise ValueError("bits must be a multiple of 64")
    cols = [F.col(names.get(k, k)) for k in keys]
    known = stage
    for c in cols:
        known = known.filter(c.isNotNull())
    position = known.select(F.explode(F.array(*_positions(cols, bits))).alias("p"))
    words = position.select(F.floor(F.col("p") / 64).cast("int").alias("w"),
                            F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("p") % 64).cast("int")).alias("b"))
    blank = stage.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("w"),
                                                        F.lit(0).cast("bigint").alias("b"))
    whole = words.groupBy("w").agg(F.bit_or("b").alias("b")).unionByName(blank).groupBy("w").agg(
        F.bit_or("b").alias("b"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("words"))


def may_match(words: Column, keys: Sequence[Column | str], bits: int) -> Column:
    """True where the keys' bits are all set (a row with a NULL key: never)."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    out = F.lit(True)
    for c in cols:
        out = out & c.isNotNull()
    for p in _positions(cols, bits):
        word = F.element_at(words, F.floor(p / 64).cast("int") + 1)
        out = out & (F.call_function("shiftrightunsigned", word, (p % 64).cast("int")).bitwiseAND(1) == 1)
    return out


def only_possible(target: DataFrame, stage: DataFrame, keys: Sequence[str],
                  names: Mapping[str, str] | None = None, bits: int | None = None) -> DataFrame:
    """``target`` without rows that certainly have no partner in ``stage``; unchanged
    when the key types do not allow the test. ``names`` maps key columns of the
    target to the stage's."""
    keys = require_keys(keys)
    if not can_filter(target, stage, keys, names):
        return target
    bits = bits or filter_bits(stage)
    words = key_filter(stage, keys, names, bits).scalar()
    return target.filter(may_match(words, keys, bits))
