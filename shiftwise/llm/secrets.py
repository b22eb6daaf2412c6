"""Secret scans: patterns plus two character Markov models, all DataFrame code.

Base spans come from three patterns (``BASE``): all leftmost non-overlapping
matches of each kind, those below the kind's length dropped. Native functions
return matches but not places, so a text is also split at the same pattern: the
lengths of the pieces and of the matches alternate, and a running sum over them
(a window per row and kind, on lengths only, never on texts) gives every start
and end in code points.

The method adds spans of kind ``random``: tokens of at least ``MIN_TOKEN``
token characters that touch no base span and whose log-likelihood ratio under
two first-order character models, one of random strings and one of ordinary
identifiers, passes ``min_mean`` nats per transition. The models are bigram
counts of labelled samples drawn from all documents, one grouped aggregation,
add-half smoothing. Their
size is fixed by the alphabet (at most 95 x 95 rows and class reach the driver)
and they go into the plan as one array of log ratios.

Edge cases: a null text is empty and has no spans; a null ``doc_id`` or
repeated rows are judged row by row; samples of one class only, or none, leave
the other model uniform; characters outside printable ASCII never are part of
a token. Other columns are not read, and clashing names do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftwise.llm._io import fresh_names, prepare, stable_input

#: Kind -> (pattern, group whose length counts, least length).
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # maximal runs, so the length may stand in the pattern
}
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_TOKEN = 20
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
KINDS = ["assign", "access", "hex", "random"]
_LOW, _N = 32, 95  # printable ASCII


# --- models ---------------------------------------------------------------

def bigram_counts(samples: DataFrame, text: str = "sample", label: str = "label") -> DataFrame:
    """(label, a, b, n): transitions between ASCII codes in labelled samples (a
    column ``n`` of ``samples`` says how often each stands for)."""
    times = F.col("n") if "n" in samples.columns else F.lit(1)
    codes = F.transform(F.split(F.col(text), ""), lambda c: F.ascii(c))
    # Neighbours side by side: one pass over a sample of any length.
    pairs = F.arrays_zip(codes.alias("a"), F.slice(codes, F.lit(2), F.length(text)).alias("b"))
    return (samples.filter(F.length(text) > 1)
            .select(F.col(label).cast("int").alias("label"), times.alias("n"), F.inline(pairs).alias("a", "b"))
            .filter(f"a between {_LOW} and {_LOW + _N - 1} and b between {_LOW} and {_LOW + _N - 1}")
            .groupBy("label", "a", "b").agg(F.sum("n").alias("n")))


def train(samples: DataFrame, text: str = "sample", label: str = "label") -> list[float]:
    """Log ratios log P(b | a, random) / P(b | a, ordinary), index
    (a - 32) * 95 + (b - 32); label 1 marks random strings."""
    count = {0: [0.0] * (_N * _N), 1: [0.0] * (_N * _N)}
    for r in bigram_counts(samples, text, label).collect():  # at most 2 x 95 x 95 rows
        if r["label"] in count:
            count[r["label"]][(r["a"] - _LOW) * _N + r["b"] - _LOW] += r["n"]
    out = [0.0] * (_N * _N)
    for a in range(_N):
        row = slice(a * _N, (a + 1) * _N)
        tot = [sum(count[c][row]) + 0.5 * _N for c in (0, 1)]
        for b in range(a * _N, (a + 1) * _N):
            out[b] = round(math.log((count[1][b] + 0.5) / tot[1]) - math.log((count[0][b] + 0.5) / tot[0]), 6)
    return out


def sample_strings(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Labelled samples (sample, label, n) drawn from all of ``docs``.

    Ordinary: every word, what joins neighbours in camelCase, snake_case,
    UPPER_CASE, kebab-case, paths and assignments, and with every eight words a
    rule of one separator, digits as in numbers and dates. A join is sampled as
    the characters that meet, so equal samples are many and are counted before
    they are taken apart. Random: digests of the ids in hex, base64 (also
    url-safe) and upper-case letters."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    # Few bytes, much work: the ids are dealt to as many tasks as there are partitions.
    ids = ids.repartition(parts)
    digest = F.sha2(F.col("id").cast("string"), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(digest)), "=+$", "")
    random = ids.select(F.explode(F.array(
        digest, b64, F.upper(F.regexp_replace(b64, "[+/a-z]", "")),
        F.regexp_replace(b64, "[+/]", ""), F.translate(b64, "+/", "-_"))).alias("sample"))
    words = F.filter(F.regexp_extract_all(F.col("t"), F.lit(r"[A-Za-z][A-Za-z0-9_-]{3,}"), F.lit(0)),
                     lambda x: ~x.rlike("[0-9]{3}|[a-f0-9]{12}"))

    def join(x: Column, i: Column) -> Column:
        """Samples of the i-th word and its neighbour, of one kind by turns."""
        y = F.get("w", i + 1)
        last, first = F.right(x, F.lit(1)), F.left(y, F.lit(1))
        digits = F.lpad(F.pmod(F.xxhash64(x, i), F.lit(10**12)).cast("string"), 12, "0")
        digit = [F.substring(digits, k, 1) for k in (1, 2)]
        turn = F.pmod(i, F.lit(8))
        kinds = [
            F.array(F.concat(last, F.initcap(y))),
            F.array(F.concat(last, F.lit("_"), first)),
            F.array(F.upper(x), F.upper(F.concat(last, F.lit("_"), first))),
            F.array(F.concat(last, F.lit("/"), first), F.concat(F.lit("/"), first)),
            F.array(F.concat(last, F.lit("-"), first)),
            F.array(F.concat(last, F.lit("="), first), F.concat(last, F.lit("+"), first)),
            F.array(F.repeat(F.substring(F.lit("_-=/+"), F.pmod(F.floor(i / 8), F.lit(5)).cast("int") + 1, F.lit(1)),
                             F.lit(20))),
            F.array(*[F.substring(digits, k, 3) for k in (1, 4, 7, 10)], F.concat(last, digit[0]),
                    *[F.concat(digit[0], F.lit(sep), digit[1]) for sep in "-/"], F.concat(digit[0], F.lit("_"), first)),
        ]
        out = kinds[-1]
        for k, own in reversed(list(enumerate(kinds[:-1]))):
            out = F.when(turn == k, own).otherwise(out)
        return out

    pieces = F.concat("w", F.filter(F.flatten(F.transform("w", join)), lambda x: x.isNotNull()))
    ordinary = (docs.select(F.col(text).alias("t")).filter("t is not null").select(words.alias("w"))
                .select(F.explode(pieces).alias("sample")).groupBy("sample").agg(F.count("*").alias("n")))
    return (random.select("sample", F.lit(1).alias("label"), F.lit(1).cast("long").alias("n"))
            .unionByName(ordinary.withColumn("label", F.lit(0))))


def mean_ratio(token: Column, model: list[float]) -> Column:
    """Mean log ratio per transition of a token of printable ASCII."""
    # One string literal, folded to one array literal: 9,025 literals would slow the planner.
    ratios = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    codes = F.transform(F.split(token, ""), lambda c: F.ascii(c) - _LOW)
    total = F.aggregate(
        codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.when(
            acc["last"] >= 0, F.get(ratios, acc["last"] * _N + c)).otherwise(0.0)).alias("sum")),
        lambda acc: acc["sum"])
    return total / F.greatest(F.length(token) - 1, F.lit(1))


# --- spans ----------------------------------------------------------------

def _may_hold(kind: str, t: Column) -> Column:
    """A cheap test that every text with a match passes."""
    if kind == "assign":
        low = F.lower(t)
        out = F.lit(False)
        for w in ASSIGN_WORDS:
            out = out | low.contains(w)
        return out
    if kind == "access":
        return t.contains("AKIA")
    return F.lit(True)


def _pieces(kind: str, pattern: str, group: int, t: Column) -> Column:
    """array<struct<kind, i, gap, len, size, token>>: every match of a kind with
    the length of the text before it (since the match before)."""
    match = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(t, F.lit(pattern), F.lit(group)) if group else match
    zipped = F.arrays_zip(F.split(t, pattern, -1).alias("p"), match.alias("m"), value.alias("v"))
    keep_text = kind == "random"
    rows = F.transform(zipped, lambda z, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(z["p"]).alias("gap"),
        F.length(z["m"]).alias("len"), F.length(z["v"]).alias("size"),
        (z["m"] if keep_text else F.lit(None).cast("string")).alias("token")))
    # The last piece follows no match.
    rows = F.filter(rows, lambda x: x["len"].isNotNull())
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,size:int,token:string>>")
    return F.when(_may_hold(kind, t) & t.rlike(pattern), rows).otherwise(none)


def spans(docs: DataFrame, model: list[float], id_col: str = "doc_id", text: str = "text",
          min_mean: float = 1.0, min_token: int = MIN_TOKEN) -> DataFrame:
    """One row per row of ``docs``: doc_id, row_id, n_chars and ``spans``, an
    array of (start, kind, end) sorted by start and kind order; kind is the
    index in KINDS, ends are exclusive, places are code points."""
    prepare(docs.sparkSession)
    t = F.coalesce(F.col("t"), F.lit(""))
    arrays = [_pieces(k, p, g, t) for k, (p, g, _) in BASE.items()]
    arrays.append(_pieces("random", TOKEN % min_token, 0, t))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("t"),
                       F.monotonically_increasing_id().alias("row_id"))
    each = rows.select("doc_id", "row_id", F.length(t).alias("n_chars"),
                       F.explode_outer(F.concat(*arrays)).alias("x")).select("doc_id", "row_id", "n_chars", "x.*")
    run = Window.partitionBy("row_id", "kind").orderBy("i")
    least = F.element_at(F.create_map(*[x for k, v in enumerate(BASE.values()) for x in (F.lit(k), F.lit(v[2]))]),
                         F.col("kind"))
    placed = (each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(run))
              .withColumn("start", F.col("end") - F.col("len"))
              .withColumn("base", F.col("kind") < len(BASE))
              .withColumn("ok", F.when(F.col("base"), F.col("size") >= least)
                          .when(F.col("token").isNotNull(), mean_ratio(F.col("token"), model) >= min_mean)))
    # A random token may not touch a base span that is kept.
    place = Window.partitionBy("row_id").orderBy("start", "kind")
    kept_base = F.col("base") & F.col("ok")
    placed = (placed
              .withColumn("before", F.max(F.when(kept_base, F.col("end"))).over(
                  place.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("after", F.min(F.when(kept_base, F.col("start"))).over(
                  place.rowsBetween(1, Window.unboundedFollowing)))
              .withColumn("good", F.col("ok") & (F.col("base") | (
                  (F.coalesce("before", F.lit(0)) <= F.col("start"))
                  & (F.coalesce("after", F.col("end")) >= F.col("end"))))))
    span = F.when(F.col("good"), F.struct(F.col("start").cast("long").alias("start"), "kind",
                                          F.col("end").cast("long").alias("end")))
    return (placed.groupBy("row_id")
            .agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"),
                 F.sort_array(F.collect_list(span)).alias("spans")))


def _named(s: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(s, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))


def secret_report(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans (kind:start:end, comma-joined) and n_random."""
    model = train(sample_strings(docs)) if model is None else model
    found = spans(docs, model)

    def of_kind(i: int) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == i)).cast("long")

    n = {k: of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)}
    base = F.filter("spans", lambda x: x["kind"] < len(BASE))
    return found.select("doc_id", n["assign"], n["access"], n["hex"],
                        F.sha2(_named(base), 256).alias("base_sha256"),
                        _named(F.col("spans")).alias("spans"), n["random"])


def redact(docs: DataFrame, model: list[float] | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` and ``n_chars`` (if there)
    brought up to date; rows without spans are unchanged.

    Spans are joined back by ``row_id``, a number of the input row: an input that
    is no stored table is stored first, so that both reads number rows alike."""
    docs = stable_input(docs, "secret-texts")
    model = train(sample_strings(docs)) if model is None else model
    row, found_at, merged_at, new = fresh_names(docs, "row", "spans", "merged", "text")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = spans(docs, model).filter(F.size("spans") > 0).select(
        F.col("row_id").alias(row), F.col("spans").alias(found_at))
    joined = numbered.join(found, row, "left")
    text = F.col("text")
    # Overlapping spans (of different kinds) become one: cut where a new run begins.
    merged = F.aggregate(
        found_at, F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))))
    before = lambda i: F.when(i > 0, F.get(merged_at, i - 1)["end"]).otherwise(F.lit(0))
    parts = F.transform(merged_at, lambda x, i: F.concat(
        F.substring(text, before(i).cast("int") + 1, (x["start"] - before(i)).cast("int")), F.lit(mask)))
    tail = F.substring(text, F.element_at(merged_at, -1)["end"].cast("int") + 1, F.length(text))
    new_text = F.when(F.col(found_at).isNull(), text).otherwise(F.concat(F.concat_ws("", parts), tail))
    out = joined.withColumn(merged_at, merged).withColumn(new, new_text)
    columns = [F.col(new).alias("text") if c == "text"
               else F.when(F.col(found_at).isNull(), F.col(c)).otherwise(F.length(new).cast("long")).alias(c)
               if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.select(*columns)
