"""Hard negatives against scoring every pair; intervals that always hold."""

import math
import random

import numpy as np
import pytest

from shiftwise.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, id int, z string, code string, rank int, score int"
EXTRA = (1, "z", "c", 2, 3)


def model(rows, every=50):
    kept = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        z = [math.floor(256 * float(np.float32(x))) for x in v]
        label = (label + 1) % 10 if i % 7 == 0 else label
        if i not in kept or (label, z) < kept[i]:
            kept[i] = (label, z)
    out = []
    for a, (la, za) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(za, z)), i, label) for i, (label, z) in kept.items() if i != a)
        for s, p, _ in [e for e in scored if e[2] == la][:5]:
            band = [(i, -n) for n, i, label in scored if label != la and -50 * s <= -100 * n <= -95 * s]
            out += [(a, p, k, i, -s, n) for k, (i, n) in enumerate(band[:3], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = [(i, rng.randrange(3), [rng.choice([0.0, 0.1, -0.2, 0.5, 1.0]) for _ in range(rng.choice([8, 8, 8, 5, 0]))])
           for i in range(300)]
    out += [(i, 1, [0.5] * 8) for i in range(300, 450)]  # a third of all rows are copies of one vector
    return out + [(None, 1, [1.0]), (451, None, [1.0]), (452, 1, None), (453, 1, [None, 1.0]),
                  (454, 2, [float("nan")]), (455, 2, [float("inf"), 1.0]), (50, 2, [0.25] * 8), (50, 2, [0.25] * 8),
                  (-50, 1, [0.5] * 8)]


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [tuple(r) for r in df.select("vec_id", "label", "embedding").collect()]
    assert rows_of(H.hard_negatives(df)) == model(rows)


def test_awkward_rows(spark, rows):
    assert rows_of(H.hard_negatives(table(spark, rows))) == model(rows)


def test_small_blocks_and_tiles(spark, rows, monkeypatch):
    for name, n in (("ROW_BLOCK", 100), ("ANCHOR_BLOCK", 3)):
        monkeypatch.setattr(H, name, n)
    assert rows_of(H.hard_negatives(table(spark, rows))) == model(rows)


def test_no_rows(spark):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    assert H.hard_negatives(table(spark, [(50, 1, []), (51, 1, [])])).collect() == []


def test_very_large_components(spark):
    big = [(50, 1, [1e7, 2.0]), (51, 1, [9e6, 1.0]), (53, 2, [6e6, 3.0]), (54, 2, [3e6, 1.0]), (55, 3, [-6e6, 0.0])]
    assert rows_of(H.hard_negatives(table(spark, big))) == model(big)  # beyond 2^53, exact
    huge = [(50, 1, [1e30]), (51, 1, [1e30]), (53, 2, [0.6e30])]
    assert H.hard_negatives(table(spark, huge)).collect() is not None


@pytest.mark.parametrize("dims", [3, 64, 100])
def test_intervals_hold(dims):
    rng = np.random.default_rng(dims)
    z = np.floor(256 * rng.normal(size=(500, dims)) * rng.choice([0.01, 1, 50], (500, 1)))
    z[:5] = 0
    z[5:10] = z[10:15]
    q = np.concatenate([z[:40], -z[20:40], np.floor(256 * rng.normal(size=(40, dims)))])
    bits = H.width(dims)
    code, length, alignment = H.encode(z, bits)

    class Rows:
        pass

    rows = Rows()
    rows.code, rows.length, rows.alignment = code, length, alignment
    rows.rest = np.sqrt(np.maximum(1 - (alignment ** 2).sum(axis=1), 0))
    low, high = H._intervals(rows, np.arange(500), H._Queries(q, bits), np.arange(len(q)), H._unit(q)[1])
    exact = z @ q.T
    assert (low <= exact).all() and (exact <= high).all()
    size = np.outer(length, H._unit(q)[1])
    assert ((high - low)[size > 0] < 0.5 * size[size > 0]).mean() > 0.9  # lengths alone allow 2


def test_rotation_keeps_products():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 40))
    turned = H.rotate(x, H.width(40))
    assert turned.shape == (20, 64) and np.allclose(turned @ turned.T, x @ x.T)


def test_integer_scores_are_exact():
    x = np.array([[2.0 ** 40, 3.0], [2.0, 1.0]])
    y = np.array([[2.0 ** 40, 5.0], [4.0, 1.0]])
    assert H._scores(x, y).tolist() == [[2 ** 80 + 15, 2 ** 42 + 3], [2 ** 41 + 5, 9]]
