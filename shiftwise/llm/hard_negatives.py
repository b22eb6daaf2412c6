"""Hard negatives for embedding anchors: rotated one-bit codes, then exact scores.

Vectors become integers (floor(scale * x)); the score of two rows is the inner
product of theirs. Anchors are a stated set of queries, held block by block
against all rows.

Codes. A vector z is rotated by random signs and Hadamard transforms (seeded,
orthonormal, padded with zeros to a power of two of at least 64). Its code is one
bit per coordinate, the sign; what the code vector leaves of z is coded again, in
all ``STAGES`` times. With the codes are stored the length of z and each stage's
*alignment* a, the product of what was left of z / |z| and the unit code vector.
An anchor q is rotated likewise, and its coordinates are held in ``QUERY_BITS``
bit planes, so that its product with a code vector is a few popcounts.

Interval. z / |z| is the sum of a x over the stages, x being their unit code
vectors, plus a rest of length e that stands at right angles to the last x. Let p
be the product of x and the quantised anchor, and r the length of what quantising
lost. The sum of a p is off by at most r sqrt(1 - e^2), and by Cauchy-Schwarz the
rest adds at most e sqrt(1 - s^2), where s is the anchor's product with the last
x, at least |p| - r. So the score lies within |z| |q| times (sum of a p, plus or
minus both). This bound is certain, not likely: a pair whose interval cannot
reach what its anchor already holds, or its band, is dropped, and every other
pair gets its integer score. The result is the one that scoring all pairs gives.

Plan. Coded rows are stored once and dealt by a hash into row blocks and anchor
blocks of bounded size; a task meets one of each (cogroup), goes through its rows
in tiles, keeps the best of each anchor, and raises its floors as it goes. What
it returns (at most ``positives``, or ``negatives`` per positive, for each anchor)
is ranked across blocks. First positives are found, then the negatives of the
bands they set. No block depends on another; nothing passes through the driver.

Edge cases. Rows with a null id, label or vector, or a null or non-finite
component, take no part. Of rows that share an id the least (by label, then
vector) counts. Shorter vectors are filled up with zeros, an empty one scores 0.
Sums beyond 2^53 are formed with Python integers; scores beyond a long are cut
to it before bands are set. Equal scores go by id. An empty table gives no row. Other columns are not
read.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm._io import materialise, prepare

SEED = 7
ROUNDS = 3
QUERY_BITS = 6
STAGES = 4
ROW_BLOCK, ANCHOR_BLOCK = 8192, 4096
ROW_TILE, ANCHOR_TILE = 2048, 512
#: Added to intervals, relative to the two lengths: far above rounding of doubles.
SLACK, SLACK_SINGLE = 1e-7, 1e-5

CODED_DDL = "id long, label long, z array<double>, code binary, length double, alignment array<double>"
FOUND = pa.schema([(c, pa.int64()) for c in ("anchor", "positive", "row", "score")])
FOUND_DDL = "anchor long, positive long, row long, score long"


# --- codes --------------------------------------------------------------------------------

def width(dims: int) -> int:
    """Bits of a code: a power of two, at least 64."""
    return max(64, 1 << max(0, dims - 1).bit_length())


def rotate(z: np.ndarray, bits: int, seed: int = SEED) -> np.ndarray:
    """Rows of ``z`` padded to ``bits`` columns and rotated."""
    out = np.zeros((len(z), bits))
    out[:, :z.shape[1]] = z
    rng = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        out *= rng.choice([-1.0, 1.0], bits)
        step = 1
        while step < bits:
            pairs = out.reshape(len(z), -1, 2, step)
            out = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]],
                                 axis=2).reshape(len(z), bits)
            step *= 2
        out /= np.sqrt(bits)
    return out


def _matrix(lists, dims: int) -> np.ndarray:
    out = np.zeros((len(lists), dims))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def _unit(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of length 1 or 0, their lengths), safe for very large components."""
    top = np.abs(z).max(axis=1, initial=0.0)
    scaled = z / np.where(top > 0, top, 1.0)[:, None]
    length = np.sqrt((scaled ** 2).sum(axis=1))
    return scaled / np.where(length > 0, length, 1.0)[:, None], length * top


def encode(z: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes: rows x stages x 64-bit words, lengths, alignments: rows x stages)."""
    unit, length = _unit(z)
    left = rotate(unit, bits)
    code = np.empty((len(z), STAGES, bits // 64), np.uint64)
    alignment = np.empty((len(z), STAGES))
    for k in range(STAGES):
        code[:, k] = np.packbits(left > 0, axis=1, bitorder="little").view(np.uint64)
        alignment[:, k] = np.abs(left).sum(axis=1) / np.sqrt(bits)
        left -= np.where(left > 0, 1.0, -1.0) * (alignment[:, k, None] / np.sqrt(bits))
    return code, length, alignment


def coded(vectors: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """(id, label, z, code, length, alignment) of every row that takes part."""
    v = F.col(vector).cast("array<double>")
    z = F.transform(v, lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double"))
                    .otherwise(x * scale))
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), z.alias("z"))
    rows = rows.filter("id is not null and label is not null and z is not null and not exists(z, x -> x is null)")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "z")).alias("r")).select("id", "r.label", "r.z")
    stored = materialise(rows, "negatives-rows")
    dims = stored.agg(F.max(F.size("z"))).first()[0] or 0

    def codes(batches):
        for batch in batches:
            z = np.floor(_matrix(batch.column("z").to_pylist(), dims))
            code, length, alignment = encode(z, width(dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(list(z), pa.list_(pa.float64())),
                 pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length),
                 pa.array(list(alignment), pa.list_(pa.float64()))],
                names=["id", "label", "z", "code", "length", "alignment"])

    return materialise(stored.mapInArrow(codes, CODED_DDL), "negatives-coded")


# --- one block of rows against one block of anchors ----------------------------------------

class _Side:
    """The columns of a block as arrays."""

    def __init__(self, table: pa.Table, dims: int):
        self.id = np.asarray(table.column("id").to_pylist(), np.int64)
        self.label = np.asarray(table.column("label").to_pylist(), np.int64)
        self.z = _matrix(table.column("z").to_pylist(), dims)
        self.code = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(
            len(self.id), STAGES, -1)
        self.length = np.asarray(table.column("length").to_pylist())
        self.alignment = np.asarray(table.column("alignment").to_pylist())
        self.rest = np.sqrt(np.maximum(1 - (self.alignment ** 2).sum(axis=1), 0))


class _Queries:
    """Anchors rotated and held in bit planes."""

    def __init__(self, z: np.ndarray, bits: int):
        turned = rotate(_unit(z)[0], bits)
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / (2 ** QUERY_BITS - 1), 1e-300)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.uint8)
        held = self.low[:, None] + level * self.step[:, None]
        self.total, self.lost = held.sum(axis=1), np.sqrt(((turned - held) ** 2).sum(axis=1))
        self.planes = [np.packbits(level >> k & 1, axis=1, bitorder="little").view(np.uint64)
                       for k in range(QUERY_BITS)]

    def products(self, code: np.ndarray, of: np.ndarray, kind) -> np.ndarray:
        """<code vector, quantised anchor> for every row and every anchor of ``of``."""
        bits = 64 * code.shape[1]
        weight = np.zeros((len(code), len(of)), np.uint16 if bits <= 512 else np.uint32)
        for w in range(code.shape[1]):
            word = code[:, w, None]
            for k, plane in enumerate(self.planes):
                weight += np.left_shift(np.bitwise_count(word & plane[None, of, w]), k, dtype=weight.dtype)
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.float64)
        scale = 1 / np.sqrt(bits)
        out = weight.astype(kind)
        out *= (2 * scale * self.step[of]).astype(kind)
        out += np.multiply.outer((2 * scale * ones).astype(kind), self.low[of].astype(kind))
        out -= (scale * self.total[of]).astype(kind)
        return out


def _intervals(rows: _Side, at: np.ndarray, queries: _Queries, of: np.ndarray, lengths: np.ndarray):
    """(lowest, highest) possible score of each pair, in single precision unless
    lengths are very large."""
    large = max(rows.length[at].max(initial=0), lengths[of].max(initial=0)) > 1e15
    kind, slack = (np.float64, SLACK) if large else (np.float32, SLACK_SINGLE)
    size = np.multiply.outer(rows.length[at], lengths[of]).astype(kind)
    rest, lost = rows.rest[at].astype(kind)[:, None], queries.lost[of].astype(kind)[None]
    middle = 0
    for k in range(STAGES):
        p = queries.products(rows.code[at, k], of, kind)
        middle = middle + rows.alignment[at, k].astype(kind)[:, None] * p
    half = np.maximum(np.abs(p) - lost, 0)
    half = rest * np.sqrt(np.maximum(1 - half * half, 0))
    half += lost * np.sqrt(np.maximum(1 - rest * rest, 0)) + kind(slack)
    return size * (middle - half), size * (middle + half)


def _scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``x`` with all of ``y``: exact doubles,
    or Python integers where sums pass 2^53."""
    if x.shape[1] * np.abs(x).max(initial=0) * np.abs(y).max(initial=0) < 2 ** 53:
        return x @ y.T
    whole = np.vectorize(int, otypes=[object])
    return whole(x) @ whole(y).T


def _as_long(score) -> int:
    return int(max(min(int(score), 2 ** 63 - 1), -2 ** 63))


def _survivors(rows: _Side, ri: np.ndarray, anchors: _Side, ai: np.ndarray, queries: _Queries, wanted):
    """Tile by tile, the pairs of the rows ``ri`` and the anchors ``ai`` that
    ``wanted(rows, anchors, low, high)`` keeps, as (row numbers, anchor numbers,
    scores): what no interval rules out is scored."""
    for r in range(0, len(ri), ROW_TILE):
        at = ri[r:r + ROW_TILE]
        for q in range(0, len(ai), ANCHOR_TILE):
            of = ai[q:q + ANCHOR_TILE]
            keep = wanted(at, of, *_intervals(rows, at, queries, of, anchors.length))
            x, y = np.flatnonzero(keep.any(axis=1)), np.flatnonzero(keep.any(axis=0))
            if len(x):
                scores = _scores(rows.z[at[x]], anchors.z[of[y]])
                i, j = np.nonzero(keep[np.ix_(x, y)])
                yield at[x[i]], of[y[j]], scores[i, j]


def _keep(best: pd.DataFrame | None, found: pd.DataFrame, by: list[str], most: int) -> pd.DataFrame:
    """The best ``most`` of each group, highest score first, then smallest id."""
    held = found if best is None else pd.concat([best, found])
    held = held.sort_values([*by, "score", "row"], ascending=[True] * len(by) + [False, True], kind="stable")
    return held[held.groupby(by).cumcount() < most]


def _raise_floor(floor: np.ndarray, best: pd.DataFrame, by: list[str], most: int) -> None:
    """What a score must reach to matter, for groups that are full (a little less,
    as intervals are rounded)."""
    full = best.groupby(by).score.agg(["size", "min"])
    full = full[full["size"] == most]
    at = tuple(full.index.get_level_values(c).to_numpy(int) for c in by)
    least = full["min"].to_numpy(float)
    floor[at] = np.maximum(floor[at], least - 1e-6 * np.abs(least) - 1e-6)


def _positives(rows: pa.Table, anchors: pa.Table, dims: int, most: int) -> pa.Table:
    """The best ``most`` rows of its own label for each anchor."""
    r, a = _Side(rows, dims), _Side(anchors, dims)
    queries = _Queries(a.z, width(dims))
    floor = np.full(len(a.id), -np.inf)
    best = None

    def wanted(at, of, low, high):
        return (high >= floor[of]) & (r.id[at, None] != a.id[None, of])

    for label in np.unique(a.label):
        same = np.flatnonzero(r.label == label), np.flatnonzero(a.label == label)
        for i, j, score in _survivors(r, same[0], a, same[1], queries, wanted):
            found = pd.DataFrame({"a": j, "row": r.id[i], "score": score})
            best = _keep(best, found[found.score >= floor[j]], ["a"], most)
            _raise_floor(floor, best, ["a"], most)
    if best is None:
        return FOUND.empty_table()
    at = best.a.to_numpy(int)
    return pa.table({"anchor": pa.array(a.id[at], pa.int64()), "positive": pa.nulls(len(at), pa.int64()),
                     "row": pa.array(best.row.to_numpy(np.int64)),
                     "score": pa.array([_as_long(x) for x in best.score], pa.int64())})


def _negatives(rows: pa.Table, anchors: pa.Table, dims: int, most: int, low_pc: int, high_pc: int) -> pa.Table:
    """The best ``most`` rows of another label in the band of each positive."""
    r, a = _Side(rows, dims), _Side(anchors, dims)
    queries = _Queries(a.z, width(dims))
    positives = [[(p["positive"], p["score"]) for p in ps] for ps in anchors.column("positives").to_pylist()]
    n = max(map(len, positives))
    # A band is empty below 0, and for a missing positive.
    p = np.array([[ps[k][1] if k < len(ps) else -1 for k in range(n)] for ps in positives], object)
    edge = np.where(p >= 0, p, 0).astype(float) / 100
    floor = np.where(p >= 0, edge * low_pc * (1 - 1e-6) - 1e-6, np.inf)
    top = np.where(p >= 0, edge * high_pc * (1 + 1e-6) + 1e-6, -np.inf)
    best = None

    def wanted(at, of, low, high):
        least, most_ = floor[of].min(axis=1).astype(low.dtype), top[of].max(axis=1).astype(low.dtype)
        return (high >= least) & (low <= most_) & (r.label[at, None] != a.label[None, of])

    for i, j, score in _survivors(r, np.arange(len(r.id)), a, np.arange(len(a.id)), queries, wanted):
        for k in range(n):
            hit = np.flatnonzero(((score >= floor[j, k]) & (score <= top[j, k])).astype(bool))
            s, q = score[hit].astype(object), p[j[hit], k]
            inside = [low_pc * y <= 100 * int(x) <= high_pc * y for x, y in zip(s, q)]
            hit = hit[np.array(inside, bool)]
            if len(hit):
                found = pd.DataFrame({"a": j[hit], "k": k, "row": r.id[i[hit]], "score": score[hit]})
                best = _keep(best, found, ["a", "k"], most)
                _raise_floor(floor, best, ["a", "k"], most)
    if best is None:
        return FOUND.empty_table()
    at, k = best.a.to_numpy(int), best.k.to_numpy(int)
    return pa.table({"anchor": pa.array(a.id[at], pa.int64()),
                     "positive": pa.array([positives[x][y][0] for x, y in zip(at, k)], pa.int64()),
                     "row": pa.array(best.row.to_numpy(np.int64)),
                     "score": pa.array([_as_long(x) for x in best.score], pa.int64())})


# --- all blocks ---------------------------------------------------------------------------

def _meet(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, work) -> DataFrame:
    """``work`` on every pair of a row block and an anchor block."""
    rb, ab = max(1, -(-n_rows // ROW_BLOCK)), max(1, -(-n_anchors // ANCHOR_BLOCK))
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (rows.withColumn("rb", F.pmod(F.xxhash64("id"), F.lit(rb)).cast("int")).withColumn("ab", blocks(ab)))
    anchors = anchors.select(*[F.col(c).alias(f"q_{c}") for c in anchors.columns])
    right = (anchors.withColumn("ab", F.pmod(F.xxhash64("q_id"), F.lit(ab)).cast("int")).withColumn("rb", blocks(rb)))

    def one(key, x: pa.Table, y: pa.Table) -> pa.Table:
        if not len(x) or not len(y):
            return FOUND.empty_table()
        return work(x, y.rename_columns([c.removeprefix("q_") for c in y.column_names]))

    return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab")).applyInArrow(one, FOUND_DDL)


def mine(vectors: DataFrame, anchors: DataFrame, dims: int, positives: int = 5, negatives: int = 3,
         low_pc: int = 50, high_pc: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)
    for ``anchors``, some of the rows of ``vectors`` (both as ``coded`` gives them)."""
    n_rows, n_anchors = vectors.count(), anchors.count()
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "row")
    near = _meet(vectors, anchors, n_rows, n_anchors, partial(_positives, dims=dims, most=positives))
    near = (near.withColumn("k", F.row_number().over(best)).filter(F.col("k") <= positives)
            .groupBy(F.col("anchor").alias("id"))
            .agg(F.array_sort(F.collect_list(F.struct("k", F.col("row").alias("positive"), "score"))).alias("positives")))
    near = materialise(near, "negatives-positives")
    found = _meet(vectors, anchors.join(near, "id"), n_rows, n_anchors,
                  partial(_negatives, dims=dims, most=negatives, low_pc=low_pc, high_pc=high_pc))
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    scores = near.select(F.col("id").alias("anchor"), F.inline("positives").alias("k", "positive", "positive_score"))
    return (ranked.withColumnsRenamed({"score": "negative_score", "row": "negative_id"})
            .join(scores.drop("k"), ["anchor", "positive"])
            .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"),
                    F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def hard_negatives(vectors: DataFrame, id: str = "vec_id", label: str = "label", vector: str = "embedding",
                   every: int = 50, relabel_every: int = 7, labels: int = 10) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``; where it is
    divisible by ``relabel_every``, the label first moves on by one (modulo ``labels``)."""
    prepare(vectors.sparkSession)
    moved = F.when(F.col(id) % relabel_every == 0, (F.col(label).cast("long") + 1) % labels).otherwise(F.col(label))
    rows = vectors.select(F.col(id).alias("id"), moved.alias("label"), F.col(vector).alias("vector"))
    rows = coded(rows, "id", "label", "vector")
    dims = rows.agg(F.max(F.size("z"))).first()[0] or 0
    return mine(rows, rows.filter(F.col("id") % every == 0), max(dims, 1))
