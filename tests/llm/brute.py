"""Plain Python versions of the operators' results, for small tables."""

import hashlib
import re
from collections import defaultdict

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x or "")


def words(x):
    return WORD.findall(lower(x))


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def licenses(x, phrases):
    w, places, labels = words(x), [], set()
    for phrase, label in phrases:
        p = phrase.split()
        for a in range(len(w) - len(p) + 1):
            if w[a:a + len(p)] == p:
                places.append(a)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def contamination(texts, items, window=10):
    pats = defaultdict(set)
    for i, x in items:
        w = words(x)
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if w else 0):
            pats[tuple(w[a:a + n])].add(None if i is None else str(i))
    out = []
    for x in texts:
        w, hit, found = words(x), set(), set()
        for n in {len(p) for p in pats}:
            for a in range(len(w) - n + 1):
                got = pats.get(tuple(w[a:a + n]))
                if got:
                    hit |= set(range(a, a + n))
                    found |= got - {None}
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def repeats(rows, length):
    """rows in text order -> (n_bytes, n_removed, n_spans, kept sha) per row."""
    seen, out = set(), []
    for x in rows:
        b = (x or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = b"\1" * length
            else:
                seen.add(s)
        spans = sum(1 for j in range(len(b)) if gone[j] and not (j and gone[j - 1]))
        out.append((len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return out


def fingerprint(x, k=3):
    w = TOKEN.findall(lower(x))
    grams = [" ".join(w[a:a + k]) for a in range(max(1, len(w) - k + 1))] if w else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def components(ids, prints, radius=3):
    """Smallest id reachable per row (None only if the whole group has none)."""
    n, group = len(ids), list(range(len(ids)))

    def top(a):
        while group[a] != a:
            a = group[a]
        return a

    for a in range(n):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                group[max(top(a), top(b))] = min(top(a), top(b))
    least = {}
    for a in range(n):
        if ids[a] is not None:
            least[top(a)] = min(least.get(top(a), ids[a]), ids[a])
    return [least.get(top(a)) for a in range(n)]


SECRETS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m.group(2)) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group(0)) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group(0)) >= 24),
]


def secrets(x):
    spans = sorted((m.start(), k, m.end()) for k, (_, rx, ok) in enumerate(SECRETS)
                   for m in rx.finditer(x or "") if ok(m))
    n = [sum(s[1] == k for s in spans) for k in range(3)]
    return (*n, sha(",".join(f"{SECRETS[k][0]}:{a}:{b}" for a, k, b in spans)))


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """sizes: source -> words; returns source -> target by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total >= most * sizes[s]]
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            open_.discard(s)
            left -= out[s]
    return out
