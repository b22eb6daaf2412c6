"""Toxicity: a convolutional text classifier trained in numpy.

Every word is the sum of the hashed embeddings of the word and of its first 4
and 6 bytes (inflected forms of a stem share them). Filters of several widths
slide over the word vectors (zero vectors beyond a text's end), ReLU, max
pooling over the whole text, and a logistic output. The model is fitted on the
driver from a bounded, deterministic sample of labelled rows (``max_pos`` and
``max_neg`` rows), the logit is re-centred so that 0.5 is the best global cut,
and one decision threshold per language is calibrated, both on all labelled rows
outside the fit, at the prevalence of all labelled rows. Scoring is one Arrow UDF over whole texts; the only thing broadcast is the
model, whose size is fixed by ``Config`` (about 4 MB).

Edge cases: a null or empty text has no words and gets the score of all-zero
pooled features; a null ``doc_id`` is not held out and never labelled; several
label rows of a document count as toxic if any is; without rows of both classes
to learn from, every score is 0.0. Other columns of ``docs`` pass through
untouched; the columns added are named by the caller's choice of ``score``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm import _text
from shiftwise.llm._io import materialise, prepare

#: Bins of the calibration's histogram per unit of the logit, and its range.
BINS, LOGITS = 64, 32


@dataclass(frozen=True)
class Config:
    buckets: int = 1 << 16
    dim: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    epochs: int = 6
    rate: float = 0.15
    max_pos: int = 2000
    max_neg: int = 3000
    seed: int = 7


@dataclass
class Model:
    config: Config
    embed: np.ndarray            # buckets x dim
    kernels: list[np.ndarray]    # per width: width x dim x filters
    bias: np.ndarray             # all filters
    out: np.ndarray              # all filters
    offset: float
    thresholds: dict[str, float]
    default_threshold: float = 0.5
    constant: float | None = None


def word_ids(w: _text.Words, buckets: int) -> np.ndarray:
    """Three hashed ids per word: the word, its first 4 bytes, its first 6."""
    hs = _text.range_hash(w.data, w.start, w.end,
                          np.minimum(w.end, w.start + 4), np.minimum(w.end, w.start + 6))
    salt = (np.uint64(0), np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))
    return np.stack([((h ^ s) % np.uint64(buckets)).astype(np.int64) for h, s in zip(hs, salt)], axis=1)


def _logits(m: Model, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Logit per text; ``first`` bounds each text's rows of ``ids``."""
    cfg, n = m.config, len(first) - 1
    pad = max(cfg.widths) - 1
    pooled = np.zeros((n, len(m.out)), dtype=np.float32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        counts = np.diff(first)
        row = np.arange(len(ids)) + pad * np.repeat(np.arange(n), counts)
        x = np.zeros((len(ids) + pad * n + pad, cfg.dim), dtype=np.float32)
        x[row] = m.embed[ids[:, 0]] + m.embed[ids[:, 1]] + m.embed[ids[:, 2]]
        at = 0
        begins = np.searchsorted(row, row[first[:-1][full]])
        for k in m.kernels:
            width, _, f = k.shape
            conv = x[:len(x) - pad] @ k[0]
            for j in range(1, width):
                conv += x[j:j + len(conv)] @ k[j]
            pooled[full, at:at + f] = np.maximum.reduceat(conv[row], begins, axis=0)
            at += f
        pooled[full] = np.maximum(pooled[full] + m.bias, 0)
        empty = counts == 0
        pooled[empty] = np.maximum(m.bias, 0)
    else:
        pooled[:] = np.maximum(m.bias, 0)
    return pooled @ m.out + m.offset


def score_texts(m: Model, texts: pa.Array) -> np.ndarray:
    """Scores of whole texts, slice by slice."""
    texts = texts.fill_null("").cast(pa.large_string())
    out = np.zeros(len(texts))
    if m.constant is not None:
        out[:] = m.constant
        return out
    for i, j in _text.slices(texts):
        w = _text.split_words(texts.slice(i, j - i), _text.ALNUM)
        z = _logits(m, word_ids(w, m.config.buckets), w.first).astype(np.float64)
        out[i:j] = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    return out


def _fit(cfg: Config, docs: list[np.ndarray], y: np.ndarray) -> Model:
    """Adagrad on the logistic loss; max pooling keeps each step's gradient to
    the one window per filter that won."""
    rng = np.random.default_rng(cfg.seed)
    nf = cfg.filters * len(cfg.widths)
    embed = rng.normal(0, 0.1, (cfg.buckets, cfg.dim)).astype(np.float32)
    kernels = [rng.normal(0, 0.5 / np.sqrt(w), (w, cfg.dim, cfg.filters)).astype(np.float32)
               for w in cfg.widths]
    out = rng.normal(0, 0.5, nf).astype(np.float32)
    bias, offset = np.zeros(nf, np.float32), 0.0
    g_embed = np.full((cfg.buckets, 1), 0.1, np.float32)
    g_k = [np.full_like(k, 0.1) for k in kernels]
    g_out, g_bias, g_off = np.full(nf, 0.1, np.float32), np.full(nf, 0.1, np.float32), 0.1
    pad = max(cfg.widths) - 1
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    for _ in range(cfg.epochs):
        for d in rng.permutation(len(docs)):
            ids = docs[d]
            n = len(ids)
            if not n:
                continue
            x = np.zeros((n + pad, cfg.dim), np.float32)
            x[:n] = embed[ids[:, 0]] + embed[ids[:, 1]] + embed[ids[:, 2]]
            z, win = np.empty(nf, np.float32), np.empty(nf, np.int64)
            for i, k in enumerate(kernels):
                conv = x[:n] @ k[0]
                for j in range(1, len(k)):
                    conv += x[j:j + n] @ k[j]
                sl = slice(i * cfg.filters, (i + 1) * cfg.filters)
                win[sl] = conv.argmax(axis=0)
                z[sl] = conv[win[sl], np.arange(cfg.filters)]
            act = np.maximum(z + bias, 0)
            p = 1 / (1 + np.exp(-np.clip(float(act @ out) + offset, -30, 30)))
            g = float((p - y[d]) * weight[d])
            if abs(g) < 1e-3:
                continue
            dz = g * out * (act > 0)
            go = g * act
            g_out += go * go
            out -= cfg.rate * go / np.sqrt(g_out)
            g_off += g * g
            offset -= cfg.rate * g / np.sqrt(g_off)
            g_bias += dz * dz
            bias -= cfg.rate * dz / np.sqrt(g_bias)
            rows, grads = [], []
            for i, k in enumerate(kernels):
                sl = slice(i * cfg.filters, (i + 1) * cfg.filters)
                live = np.flatnonzero(dz[sl])
                if not len(live):
                    continue
                d_live, w_live = dz[sl][live], win[sl][live]
                for j in range(len(k)):
                    pos = w_live + j
                    inside = pos < n
                    gx = d_live[inside, None] * k[j][:, live[inside]].T
                    for f in range(3):
                        rows.append(ids[pos[inside], f])
                        grads.append(gx)
                    gk = x[pos] * d_live[:, None]
                    g_k[i][j][:, live] += gk.T ** 2
                    k[j][:, live] -= cfg.rate * gk.T / np.sqrt(g_k[i][j][:, live])
            if rows:
                r, gr = np.concatenate(rows), np.concatenate(grads)
                np.add.at(g_embed, r, (gr ** 2).mean(axis=1, keepdims=True))
                np.add.at(embed, r, -cfg.rate * gr / np.sqrt(g_embed[r]))
    return Model(cfg, embed, kernels, bias, out, offset, {})


def _cuts(bins: DataFrame, min_rows: int, min_pos: int) -> DataFrame:
    """(lang, cut): the logit with the best F1 of every language and of all rows
    (lang null), from counts (lang, bin, y, fit, n) of labelled rows.

    Only rows outside the fit are judged; each class weighs as much as all of its
    rows, in the fit or not, so the prevalence is that of all labelled rows. The
    cut lies in the middle of the empty bins below the best one."""
    outside = F.col("n") * (1 - F.col("fit"))
    both = bins.unionByName(bins.withColumn("lang", F.lit(None).cast("string")))
    each = both.groupBy("lang", "bin").agg(
        *[F.sum(F.when(F.col("y") == c, n).otherwise(0)).alias(f"{name}{c}")
          for c in (0, 1) for name, n in (("n", outside), ("all", F.col("n")))])
    own = Window.partitionBy("lang")
    down = own.orderBy(F.desc("bin"))

    def upto(c: int) -> Column:
        weight = F.sum(f"all{c}").over(own) / F.sum(f"n{c}").over(own)
        return F.sum(f"n{c}").over(down) * weight

    f1 = 2 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("toxic"))
    rows = (each.withColumn("rows0", F.sum("n0").over(own)).withColumn("rows1", F.sum("n1").over(own))
            .filter("rows0 > 0 and rows1 > 0")
            .filter(F.col("lang").isNull() | ((F.col("rows0") + F.col("rows1") >= min_rows)
                                              & (F.col("rows1") >= min_pos)))
            .withColumn("tp", upto(1)).withColumn("fp", upto(0)).withColumn("toxic", F.sum("all1").over(own))
            .filter("n0 + n1 > 0")
            .withColumn("below", F.lead("bin").over(down)))
    cut = (F.col("bin") + F.coalesce(F.col("below") + 1, F.col("bin") - 2 * BINS)) / (2 * BINS)
    return (rows.groupBy("lang")
            .agg(F.max(F.struct(f1.alias("f1"), F.col("bin"), cut.alias("cut"))).alias("best"))
            .select("lang", "best.cut"))


def _bin(score: Column) -> Column:
    """Bin of a score's logit: 1 / BINS wide, logits beyond LOGITS in the last."""
    z = F.coalesce(F.log(score) - F.log1p(-score), F.lit(float(LOGITS)))  # log1p is null at a score of 1
    return F.floor(F.greatest(F.least(z, F.lit(float(LOGITS))), F.lit(-float(LOGITS))) * BINS).cast("int")


def train(docs: DataFrame, labels: DataFrame, config: Config = Config(),
          id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          lang: str = "lang", min_lang_rows: int = 50, min_lang_pos: int = 10) -> Model:
    """Fit a model to labelled rows, at most ``max_pos`` / ``max_neg`` of them.

    One id in five (by a hash) is never fitted on. All labelled rows outside the
    fit, those and whatever the bounds left over, are scored on Spark, and the
    global cut and the thresholds by language come from their histogram (at most
    2 * LOGITS * BINS + 1 bins a language and class; one row per language reaches
    the driver). A language with fewer than ``min_lang_rows`` such rows or
    ``min_lang_pos`` toxic ones uses the global cut. Where the rows outside the
    fit are of one class, the rows of the fit take part too.
    """
    prepare(docs.sparkSession)
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y")))
    order = F.xxhash64(F.col("id"), F.lit(config.seed))
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"),
                         F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"))
    # One id in five stays out of the fit, unless only one class is left to fit on.
    for pool in (known.filter(F.pmod(F.xxhash64(F.col("id"), F.lit(config.seed + 1)), F.lit(5)) > 0), known):
        picked = [pool.filter(F.col("y") == c).orderBy(order, "id").limit(n)
                  for c, n in ((1, config.max_pos), (0, config.max_neg))]
        sample = materialise(picked[0].unionByName(picked[1]), "toxic-sample")  # max_pos + max_neg rows at most
        # One row of each id (the least text), hashed in the executors: what comes
        # here are the word numbers of at most max_pos + max_neg texts.
        rows = (source.drop("lang").join(F.broadcast(sample), "id").groupBy("id", "y")
                .agg(F.min(F.struct("text")).alias("t"))
                .select("id", "y", _hashed(config.buckets)(F.col("t.text")).alias("words")).orderBy("id").toArrow())
        classes = np.asarray(rows.column("y").to_pylist(), np.int64)
        if len(set(classes)) == 2:
            break
    else:
        return Model(config, np.zeros((1, 1)), [], np.zeros(0), np.zeros(0), 0.0, {}, 0.5, 0.0)
    parts = [np.asarray(x.values.to_numpy(zero_copy_only=False), np.int32).reshape(-1, 3) for x in rows.column("words")]
    del rows
    model = _fit(config, parts, classes)
    del parts
    fitted = F.broadcast(sample.select("id", F.lit(1).alias("fit")))
    # Scored before the join, so that bins are shuffled and texts are not.
    binned = (source.filter("id is not null").withColumn("s", score(source, model))
              .select("id", "lang", _bin(F.col("s")).alias("bin")))
    bins = materialise(
        binned.join(known, "id").join(fitted, "id", "left").withColumn("fit", F.coalesce("fit", F.lit(0)))
        .groupBy("lang", "bin", "y", "fit").agg(F.count("*").alias("n")), "toxic-bins")
    cuts = {r["lang"]: r["cut"] for r in _cuts(bins, min_lang_rows, min_lang_pos).collect()}
    if None not in cuts:
        bins = bins.withColumn("fit", F.lit(0))
        cuts = {r["lang"]: r["cut"] for r in _cuts(bins, min_lang_rows, min_lang_pos).collect()}
    cut = cuts.pop(None)
    model.offset -= cut
    for name, c in sorted(cuts.items()):
        model.thresholds[name] = float(1 / (1 + np.exp(-np.clip(c - cut, -30, 30))))
    return model


def _hashed(buckets: int):
    """A function that gives a text's words as numbers below ``buckets``, three each."""
    @F.arrow_udf("array<int>")
    def words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            texts = texts.fill_null("").cast(pa.large_string())
            parts = []
            for i, j in _text.slices(texts, 1 << 18):  # hashing needs 60 times a slice's bytes
                w = _text.split_words(texts.slice(i, j - i), _text.ALNUM)
                ids = word_ids(w, buckets).astype(np.int32)
                parts += [ids[a:b].ravel() for a, b in zip(w.first[:-1], w.first[1:])]
            yield pa.array(parts, pa.list_(pa.int32()))
    return words


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column with the score (0 to 1) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        for texts in batches:
            yield pa.array(score_texts(m, texts), pa.float64())

    return toxicity(F.col(text))


def threshold(model: Model, lang: str = "lang") -> Column:
    """The decision threshold of a row's language."""
    default = F.lit(model.default_threshold)
    if not model.thresholds:
        return default
    # One map literal: nested conditions would grow with the number of languages.
    known = F.create_map(*[F.lit(x) for pair in sorted(model.thresholds.items()) for x in pair])
    return F.coalesce(F.try_element_at(known, F.coalesce(F.col(lang).cast("string"), F.lit(""))), default)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows the query never learns from: crc32(id as text) mod 5 = 0."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(rest == 0, F.lit(False))


def toxicity_report(docs: DataFrame, labels: DataFrame, config: Config = Config()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= 0.5),
    lang_threshold and rejected (score >= the language's threshold)."""
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs, labels.filter(~held_out()), config)
    return (docs.select("doc_id", held_out().alias("held_out"), score(docs, model).alias("score"),
                        threshold(model).alias("lang_threshold"))
            .select("doc_id", "held_out", "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted"),
                    "lang_threshold", (F.col("score") >= F.col("lang_threshold")).alias("rejected")))
