"""Vectorised word splitting and hashing of Arrow text batches (numpy).

A batch is cut into slices of a few MB. In a slice every byte is mapped through
a 256-entry table (0x20 for a separator), words are runs of other bytes that do
not cross a text's end, and a word's 64-bit hash is a polynomial over its bytes
taken from one running sum, so no Python loop runs over words.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)


def _lut(is_word) -> np.ndarray:
    t = np.full(256, 0x20, dtype=np.uint8)
    for b in range(256):
        if is_word(b):
            t[b] = b + 32 if 0x41 <= b <= 0x5A else b
    return t


#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALNUM = _lut(lambda b: b >= 0x80 or chr(b).isalnum())
#: Words ``[^\x20\x09-\x0D]+`` after lower-casing A-Z.
NONSPACE = _lut(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


@dataclass
class Words:
    """Words of a slice of texts: ``data`` mapped bytes, ``start``/``end`` byte
    bounds per word, ``first`` the index of each text's first word (n + 1)."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``size`` bytes of text each (one row at least)."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64,
                        count=len(texts) + 1 + texts.offset)[texts.offset:] if len(texts) else np.zeros(1, np.int64)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, side="right")) - 1)
        yield i, j
        i = j


def split_words(texts: pa.Array, lut: np.ndarray) -> Words:
    """Words of every text (null: none)."""
    texts = texts.fill_null("").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), z, z, np.zeros(1, np.int64))
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1 + texts.offset)[texts.offset:]
    raw = texts.buffers()[2]
    raw = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data = lut[raw[off[0]:off[-1]]]
    off = off - off[0]
    word = np.empty(len(data) + 2, dtype=bool)
    word[0] = word[-1] = False
    word[1:-1] = data != 0x20
    begins, ends = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] |= word[1:-1][cut]
    ends[cut - 1] |= word[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, off, side="left"))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.ones(n, dtype=np.uint64)
    if n > 1:
        p[1:] = np.uint64(base & (2**64 - 1))
        np.multiply.accumulate(p, out=p)
    return p


_cache: dict[str, np.ndarray] = {}


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_cache.get("p", ())) < n:
        size = 1 << (n - 1).bit_length()
        _cache["p"], _cache["q"] = _powers(_R, size), _powers(_RINV, size)
    return _cache["p"][:n], _cache["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def range_hash(data: np.ndarray, start: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of the byte ranges ``data[start:end]``, for each of ``ends``."""
    p, q = _pow_tables(len(data) + 1)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=run[1:])
    return [mix((run[e] - run[start]) * q[start] + (e - start).astype(np.uint64)) for e in ends]


def gram_hash(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hashes of runs of ``k`` consecutive words, one per possible first word
    of the slice (a run that crosses a text's end is the caller's to drop)."""
    n = len(word_hash) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + word_hash[j:j + n]
    return mix(h)
