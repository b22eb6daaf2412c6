"""Operators on single texts and set joins: licenses, decontamination,
secrets, fingerprints, token counts."""

import math
import re
import time

import brute
import pytest
from pyspark.sql import functions as F

from awkward import messy, no_rows, unstable  # noqa: F401
from shiftwise.llm import decontamination, fingerprints, licenses, secrets, token_counts


KEY = lambda t: tuple((x is None, x if x is not None else 0) for x in t)


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=KEY)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_license_base_matches_brute_force(messy):
    want = sorted(((i, *brute.licenses(x, licenses.PHRASES)) for i, x in texts(messy)), key=KEY)
    out = licenses.license_report(messy)
    assert got(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    for r in out.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["n_spans"] > 0)


def test_license_diagonals_survive_an_inserted_word(spark):
    notice = dict((label, t) for t, label in licenses.NOTICES)["bsd"].split()
    edited = " ".join(notice[:8] + ["surely"] + notice[8:])
    df = spark.createDataFrame([(1, edited), (2, " ".join(notice[:5]))], "doc_id long, text string")
    out = {r["doc_id"]: r for r in licenses.license_report(df).collect()}
    assert out[1]["labels"] == "bsd" and out[1]["n_spans"] == 1 and 0.7 < out[1]["score"] < 1
    assert out[2]["labels"] == "" and out[2]["score"] == 0
    with pytest.raises(ValueError):
        licenses.license_report(df, phrases=[("two words", "x")])


def test_inputs_that_are_no_tables(unstable):
    rows = texts(unstable)
    want = sorted(((i, *brute.licenses(x, licenses.PHRASES)) for i, x in rows), key=KEY)
    assert got(licenses.license_report(unstable), "doc_id", "n_words", "n_base", "first_word", "last_word",
               "base_labels") == want
    masked = secrets.redact(unstable, [0.0] * 95 * 95).collect()
    assert not any(sum(brute.secrets(r["text"])[:3]) for r in masked) and len(masked) == len(rows)
    assert sorted(len(r["text"] or "") for r in masked if "[SECRET]" not in (r["text"] or "")) == \
        sorted(len(x or "") for _, x in rows if not sum(brute.secrets(x)[:3]))


@pytest.mark.parametrize("filter_rows", [2_000_000, 0])
def test_contamination_matches_brute_force(spark, messy, filter_rows):
    x = dict(texts(messy))
    items = [(1, x[11]), (2, "zeta9 the"), (2, "zeta9 the"), (3, None), (4, "!!"), (None, x[12][:150]),
             (50, x[11][30:])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = texts(messy)
    want = sorted(((i, *c) for (i, _), c in zip(rows, brute.contamination([t for _, t in rows], items))), key=KEY)
    out = decontamination.contamination(messy, bench, filter_rows=filter_rows)
    assert got(out, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want
    kept = decontamination.drop_contaminated_rows(messy, bench)
    flags = [c[-1] for c in brute.contamination([t for _, t in rows], items)]
    assert kept.columns == messy.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == \
        sorted((row for row, bad in zip(rows, flags) if not bad), key=str)


def test_containment_below_one_finds_changed_windows(spark):
    item = [f"w{i}" for i in range(20)]
    doc = item[:18] + ["other", "end"]
    docs = spark.createDataFrame([(1, " ".join(doc)), (2, " ".join(reversed(item)))], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    hit = {c: {r["doc_id"]: r["contaminated"] for r in decontamination.contamination(
        docs, bench, window=20, containment=c).collect()} for c in (0.8, 1.0)}
    assert hit == {0.8: {1: True, 2: False}, 1.0: {1: False, 2: False}}
    with pytest.raises(ValueError):
        decontamination.matches(docs, bench, containment=0)


def test_no_benchmark_and_no_documents(spark, messy, no_rows):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontamination.contamination(messy, bench).collect())
    one = spark.createDataFrame([(1, "the of")], "item_id long, text string")
    assert decontamination.contamination(no_rows, one).collect() == []


def test_secret_base_spans_match_brute_force(messy):
    model = secrets.train(secrets.sample_strings(messy))
    out = secrets.secret_report(messy, model)
    want = sorted(((i, *brute.secrets(x)) for i, x in texts(messy)), key=KEY)
    assert got(out, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want


def test_markov_models_tell_random_from_ordinary(spark):
    words = ["configuration", "management", "userAccountSettings", "read_only_memory", "INTERNAL_ERROR_CODE"] * 20
    random = [brute.sha(str(i))[:40] for i in range(60)] + ["Zq7Xk2Vb9Lm4Tn8Rw3Ys6Pd1" + str(i) for i in range(40)]
    samples = spark.createDataFrame([(w, 0) for w in words] + [(r, 1) for r in random], "sample string, label int")
    model = secrets.train(samples)
    df = spark.createDataFrame([("9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c",), ("configurationmanagement",), ("a",)],
                               "t string")
    mean = [r[0] for r in df.select(secrets.mean_ratio(F.col("t"), model)).collect()]
    assert mean[0] > 1 and mean[1] < 0 and mean[2] == 0
    docs = spark.createDataFrame([(1, "key Zq7Xk2Vb9Lm4Tn8Rw3Ys6Pd1 and configurationmanagement x")],
                                 "doc_id long, text string")
    (r,) = secrets.secret_report(docs, model).collect()
    assert r["n_random"] == 1 and r["spans"].split(",")[-1].startswith("random:")


def test_secret_samples_grow_with_the_documents(spark):
    docs = spark.range(2500).select(F.col("id").alias("doc_id"), F.lit("zebra").alias("text"))
    (n,) = secrets.sample_strings(docs).filter("label = 0 and sample = 'zebra'").agg(F.sum("n")).first()
    assert n == 2500


def test_rules_paths_and_numbers_are_no_secrets(spark):
    model = secrets.train(secrets.sample_strings(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    clean = [c * 24 for c in "_-=/+"] + ["usr/lib/src/bin/foo/bar", "/home/user/projects/main/index",
                                         "20240115123000451229", "31415926535897932384626433",
                                         "2024-01-15/2024-02-20", "user_account_settings_page",
                                         "MAX_BUFFER_SIZE_IN_BYTES", "key=value/other-setting"]
    random = ["Zq7Xk2Vb9Lm4Tn8Rw3Ys6Pd1", "x8_Kq-2VbZ9Lm-4TnR_w3Ys6Pd", "dGhJ9+Qz/7Xk2Vb9Lm4Tn8Rw"]
    df = spark.createDataFrame([(x,) for x in clean + random], "t string")
    mean = {r["t"]: r["m"] for r in df.select("t", secrets.mean_ratio(F.col("t"), model).alias("m")).collect()}
    assert all(mean[x] < 1 for x in clean) and all(mean[x] >= 1 for x in random), mean


def test_method_spans_match_brute_force(spark, messy):
    """Random tokens: a plain model of the samples, run over every token."""
    rows = texts(messy) + [(900, "x " + "aB3/" * 9 + " zQ8kX1pV7mN4rT6wY2sL5 password=zQ8kX1pV7mN4rT6wY2sL5"),
                           (901, "the_quick_brown_fox_jumps_over " + "-" * 25 + " Zk9Qw2Xv7Pl4Mn8Rt1Yb6=")]
    rows += [(1000 + i, "plain words that stand in ordinary documents") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    samples = [(r["label"], r["sample"], r["n"]) for r in secrets.sample_strings(docs).collect()]
    count = {0: {}, 1: {}}
    for label, x, n in samples:
        for a, b in zip(x, x[1:]):
            if " " <= a <= "~" and " " <= b <= "~":
                count[label][a, b] = count[label].get((a, b), 0) + n
    total = {c: {} for c in count}
    for c, pairs in count.items():
        for (a, _), n in pairs.items():
            total[c][a] = total[c].get(a, 0) + n

    def ratio(a, b):
        p = [(count[c].get((a, b), 0) + 0.5) / (total[c].get(a, 0) + 0.5 * 95) for c in (0, 1)]
        return round(math.log(p[1]) - math.log(p[0]), 6)

    def found(x):
        base = [m.span() for _, rx, ok in brute.SECRETS for m in rx.finditer(x or "") if ok(m)]
        out = []
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", x or ""):
            token, (a, b) = m.group(0), m.span()
            mean = sum(map(ratio, token, token[1:])) / (len(token) - 1)
            if mean >= 1.0 and all(e <= a or s >= b for s, e in base):
                out.append(f"random:{a}:{b}")
        return ",".join(out)

    out = secrets.secret_report(docs).collect()
    got_random = sorted((str(r["doc_id"]), ",".join(s for s in r["spans"].split(",") if s.startswith("random")))
                        for r in out)
    assert got_random == sorted((str(i), found(x)) for i, x in rows)
    assert sum(r["n_random"] for r in out) >= 1


def test_one_word_of_a_million_letters(spark):
    docs = spark.createDataFrame([(1, "a" + "bcdefgh" * 143_000), (2, "Zk9Qw2Xv7Pl4Mn8Rt1Yb6" * 50_000)],
                                 "doc_id long, text string")
    began = time.time()
    out = {r["doc_id"]: r for r in secrets.secret_report(docs).collect()}
    assert time.time() - began < 60
    assert out[1]["n_random"] == 0


def test_redaction_leaves_columns_of_any_name_alone(spark, messy, tmp_path):
    messy.write.parquet(str(tmp_path / "m"))
    docs = spark.read.parquet(str(tmp_path / "m"))
    out = secrets.redact(docs)
    assert out.dtypes == docs.dtypes
    others = [c for c in docs.columns if c not in ("text", "n_chars", "tags")]
    assert sorted(map(str, out.select(*others).collect())) == sorted(map(str, docs.select(*others).collect()))


def test_secret_models_without_samples_are_uniform(spark, no_rows):
    assert set(secrets.train(secrets.sample_strings(no_rows))) == {0.0}
    assert secrets.secret_report(no_rows).collect() == []


def test_redaction_masks_spans_and_keeps_the_rest(spark, messy, tmp_path):
    messy.write.parquet(str(tmp_path / "m"))
    docs = spark.read.parquet(str(tmp_path / "m"))
    out = secrets.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    after = {r["doc_id"]: r for r in out.collect()}
    assert after[14]["text"] == "[SECRET]' [SECRET] [SECRET] token: abc"
    assert after[14]["n_chars"] == len(after[14]["text"])
    before = dict(texts(docs))
    for i in (5, 6, 9, 11, 13, 18):
        assert after[i]["text"] == before[i]


def test_fingerprints_of_whole_and_edited_texts(messy):
    out = fingerprints.fingerprint_report(messy)
    rows = sorted(texts(messy), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got_rows = out.collect()
    assert len(got_rows) == len(rows)
    # Ids that occur once, whose successor's text is certain.
    ids = [i for i, _ in rows]
    for at, (i, x) in enumerate(rows):
        nxt_id, nxt = rows[(at + 1) % len(rows)]
        if i is None or ids.count(i) > 1 or nxt_id is None or ids.count(nxt_id) > 1:
            continue
        (r,) = [g for g in got_rows if g["doc_id"] == i]
        x = x or ""
        half = len(x) // 2
        edited = x[:len(x) - half] + (nxt or "")[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(x), brute.sha(edited)), i
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (x == edited)
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        assert (r["first_edit"] is None) == (x == edited)
    by_text = {}
    for r, x in zip(sorted(got_rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_chars"])),
                    sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len(r[1] or "")))):
        by_text.setdefault(x[1] or "", set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert len({next(iter(v)) for v in by_text.values()}) == len(by_text)


def test_successors_across_slices(spark, no_rows):
    ids = [3, 10_000_000, 11, 12, 13, 10_000_001, 7, -5, 90]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    out = {r["text"]: r["next_text"] for r in fingerprints.with_next(df, slice_rows=1).collect()}
    order = sorted(ids, reverse=True)
    assert out == {f"t{a}": f"t{b}" for a, b in zip(order, order[1:] + order[:1])}
    one = spark.createDataFrame([(1, "abc def")], "doc_id long, text string")
    (r,) = fingerprints.fingerprint_report(one).collect()
    assert r["near_next"] == 1.0
    assert fingerprints.fingerprint_report(no_rows).collect() == []


def test_tree_locates_an_edit(spark):
    a = "p one two\np three\n\np four five six\np seven"
    b = a.replace("p seven", "p eight")
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        fingerprints.tree(F.col("a")).alias("a"), fingerprints.tree(F.col("b")).alias("b"))
    (r,) = df.select(fingerprints.first_difference(F.col("a"), F.col("b")).alias("d"),
                     fingerprints.first_difference(F.col("a"), F.col("a")).alias("s")).collect()
    assert (r["d"], r["s"]) == ("1:1", None)


def test_token_counts_equal_the_library(messy, no_rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    want = []
    for i, x in texts(messy):
        n = len(tok.encode(x or "", add_special_tokens=False))
        want.append((i, len((x or "").encode()), n, n > 512))
    for head in (1 << 20, 2):  # all pieces in the broadcast head; nearly all in the tail
        out = token_counts.token_counts(messy, path, head=head)
        assert got(out, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=KEY)
    assert token_counts.token_counts(no_rows, path).collect() == []


def test_pieces_rejoin_to_the_text(messy):
    rows = messy.select("text", F.concat_ws("", token_counts.pieces(F.col("text"))).alias("t")).collect()
    assert all((r["text"] or "") == r["t"] for r in rows)
