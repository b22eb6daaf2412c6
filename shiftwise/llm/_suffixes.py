"""Linear suffix sorting by grouping.

Phase 1 takes the groups of suffixes in descending order (at first: by first
symbol). For each suffix of the group it finds the nearest earlier suffix of a
smaller group, following the previous-smaller pointers already known; a suffix
that is pointed to ``k`` times extends its prefix by ``k`` copies of the
group's prefix, so it leaves its group upwards, the higher the larger ``k``.
At the end a group holds the suffixes with one longest Lyndon prefix. Phase 2
walks the order from the smallest suffix: the suffixes whose Lyndon prefix ends
where the current suffix begins are found by the same pointers and take the
next place of their groups. Nothing is renamed and nothing recurses.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``symbols``; the last symbol must be the
    smallest and occur once."""
    n = len(symbols)
    if n < 2:
        return np.arange(n)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    begin_of = np.flatnonzero(new)[np.cumsum(new) - 1]
    begin_np = np.empty(n, dtype=np.int64)
    begin_np[order] = begin_of
    place_np = np.empty(n, dtype=np.int64)
    place_np[order] = np.arange(n)
    size_np = np.zeros(n, dtype=np.int64)
    starts = np.flatnonzero(new)
    size_np[starts] = np.diff(np.append(starts, n))
    sa, begin, place, size = order.tolist(), begin_np.tolist(), place_np.tolist(), size_np.tolist()
    before = [-1] * n  # previous smaller suffix

    top = n - 1
    while top > 0:
        low = begin[sa[top]]
        if low == top:
            s = sa[top]
            p = s - 1
            while p >= 0 and begin[p] >= low:
                p = before[p]
            before[s] = p
            levels = (((p,),) if p >= 0 else ())
        else:
            count: dict[int, int] = {}
            group = sa[low:top + 1]
            group.sort()
            for s in group:
                p = s - 1
                while p >= 0 and begin[p] >= low:
                    p = before[p]
                before[s] = p
                if p >= 0:
                    count[p] = count.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, k in count.items():
                if k in by_count:
                    by_count[k].append(p)
                else:
                    by_count[k] = [p]
            levels = [by_count[k] for k in sorted(by_count, reverse=True)]
        top = low - 1
        for moving in levels:
            if len(moving) == 1:
                p = moving[0]
                b = begin[p]
                k = size[b] - 1
                if k:
                    e = b + k
                    size[b] = k
                    q = sa[e]
                    i = place[p]
                    sa[i] = q
                    place[q] = i
                    sa[e] = p
                    place[p] = e
                    begin[p] = e
                    size[e] = 1
                continue
            touched: dict[int, int] = {}
            for p in moving:
                b = begin[p]
                k = size[b] - 1
                size[b] = k
                e = b + k
                q = sa[e]
                i = place[p]
                sa[i] = q
                place[q] = i
                sa[e] = p
                place[p] = e
                touched[b] = touched.get(b, 0) + 1
            for b, moved in touched.items():
                e = b + size[b]
                size[e] = moved
                for i in range(e, e + moved):
                    begin[sa[i]] = e

    free = begin  # per suffix: its group's first place; next free place below
    next_free = list(range(n))
    done = bytearray(n)
    out = [0] * n
    out[0] = n - 1
    done[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            g = free[j]
            at = next_free[g]
            next_free[g] = at + 1
            out[at] = j
            done[j] = 1
            j = before[j]
    return np.array(out, dtype=np.int64)
