"""The trie of conversation prefixes against a plain one."""

import collections
import hashlib
import random
import zlib

import pytest

from shiftwise.llm import prefix_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, pos int, name string, n int, first int, conv int"


def model(rows):
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))

    def token(r, x):
        return hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()

    seq = {}
    for c in by:
        by[c].sort(key=lambda e: (e[0], e[1], token(e[2], e[3])))
    for c in by:
        h = zlib.crc32(str(c).encode()) % 6
        base = by.get(c - abs(c) % 100 * (1 if c >= 0 else -1), [])
        seq[c] = [(e[2], e[3]) for e in base[:h] + by[c][h:]]
    # A node is the number of its prefix; numbers are given as prefixes are met.
    step, parent, text, depth, members, ends = {}, {0: None}, {0: ""}, {0: 0}, {0: set()}, collections.defaultdict(list)
    for c, s in seq.items():
        at = 0
        members[0].add(c)
        for r, x in s:
            new = step.setdefault((at, r, x), len(parent))
            if new not in parent:
                parent[new], text[new], depth[new], members[new] = at, x, depth[at] + 1, set()
            at = new
            members[at].add(c)
        ends[at].append(c)
    kids = collections.Counter(p for p in parent.values() if p is not None)
    leaves, saved = collections.Counter(), collections.Counter()
    for node in sorted(parent, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(members[node]) - 1) * len(text[node])
        if parent[node] is not None:
            leaves[parent[node]] += leaves[node]
            saved[parent[node]] += saved[node]
    if not seq:
        return []
    return sorted(((min(members[v]), depth[v], None if parent[v] is None else min(members[parent[v]]),
                    len(members[v]), kids[v], leaves[v], saved[v],
                    hashlib.sha256(",".join(map(str, sorted(ends[v]))).encode()).hexdigest()) for v in parent), key=str)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "n", 2, 3, 4) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r[c] for c in COLUMNS) for r in T.prefix_trie(df, **options).collect()]
    assert sorted(got, key=str) == model(rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in T.prefix_trie(df).collect()]
    assert sorted(got, key=str) == model(rows)


def test_awkward_turns(spark):
    rng = random.Random(1)
    rows = []
    for c in [*range(40), 100, 101, 250, -3, -100, -101]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 7, 8, 9, 63, 64, 65, 130])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "a", None]),
                         rng.choice(["x", "xy", "é😀", None]) if t > 3 else "p"))
    rows += [(c, t, "u", "z") for c in (307, 308, 309) for t in range(200)]
    rows += [(None, 1, "a", "b"), (50, None, None, None), (60, 1, "u", "w" * 1_000_000)]
    check(spark, rows)


@pytest.mark.parametrize("block", [2, 4, 16])  # three to six levels of blocks
def test_levels_of_blocks(spark, block):
    rng = random.Random(block)
    rows = [(c, t, "u", rng.choice("ab") if rng.random() < 0.1 else "a")
            for c in range(30) for t in range(rng.choice([3, 4, 16, 17, 64, 70, 90]))]
    check(spark, rows, block=block)


def test_one_conversation_with_most_turns(spark):
    rows = [(7, t, "u", f"t{t % 3}") for t in range(5000)] + [(c, t, "u", f"t{t % 3}") for c in range(20, 60) for t in range(9)]
    check(spark, rows)


def test_copies_of_one_conversation(spark):
    rows = [(c, t, "u", "same" if c % 3 else f"{c}") for c in range(1000, 1900) for t in range(4)]
    check(spark, rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.prefix_trie(empty).collect() == []
    only_null = spark.createDataFrame([(None, 1, "a", "b", 1, "n", 2, 3, 4)], SCHEMA)
    assert T.prefix_trie(only_null).collect() == []


def test_block_must_be_a_power_of_two(spark):
    with pytest.raises(ValueError):
        T.prefix_trie(spark.createDataFrame([], SCHEMA), block=6)


def test_prefix_names_halve():
    tokens = [bytes([i]) * 32 for i in range(13)]
    names = T.prefix_names(T.ROOT, tokens, 64)
    assert len(set(names)) == 13
    for n in range(1, 14):  # the names of a prefix do not depend on what follows
        assert T.prefix_names(T.ROOT, tokens[:n], 64) == names[:n]
        low = n & -n
        root = T.ROOT if n == low else names[n - low - 1]
        assert names[n - 1] == hashlib.sha256(root + b"".join(tokens[n - low:n])).digest()
