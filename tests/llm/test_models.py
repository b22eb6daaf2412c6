"""Operators with trained models, and the pipeline."""

import brute
import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from awkward import messy, no_rows  # noqa: F401
from shiftwise.llm import decontamination, language, mixing, secrets, simhash, toxicity
from shiftwise.llm._io import materialise, table

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def test_toxicity_on_held_out_documents(spark):
    out = toxicity.toxicity_report(table(spark, SF, "documents"), table(spark, SF, "labels"))
    rows = out.join(table(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    auc = sum((t > c) + (t == c) / 2 for t in toxic for c in clean) / (len(toxic) * len(clean))
    accuracy = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    assert auc > 0.93 and accuracy > 0.93, (auc, accuracy)


def test_the_fit_sample_is_not_cut():
    assert (toxicity.Config().max_pos, toxicity.Config().max_neg) == (2000, 3000)


def test_cuts_see_all_labelled_rows(spark):
    """Both bounds bind: the cuts still come from every labelled row outside the fit."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").filter(~toxicity.held_out())
    model = toxicity.train(docs, labels, toxicity.Config(max_pos=40, max_neg=60, epochs=2))
    known = docs.join(labels, "doc_id").groupBy("lang").agg(F.count("*").alias("n"), F.sum("toxic").alias("pos"))
    # At most 100 rows are in the fit, so at least n - 100 and pos - 40 are outside it.
    sure = {r["lang"] or "" for r in known.collect() if r["n"] - 100 >= 50 and r["pos"] - 40 >= 10}
    assert len(sure) >= 3 and sure <= set(model.thresholds)


def test_cuts_weigh_classes_as_in_all_rows(spark):
    """Ten of the toxic rows and all but 100 clean ones outside the fit: the class
    weights are those of all rows, not of the rows outside."""
    rows = [("en", 64, 1, 0, 8), ("en", 0, 1, 0, 2), ("en", 64, 1, 1, 80), ("en", 0, 1, 1, 20),
            ("en", 64, 0, 0, 9), ("en", 0, 0, 0, 10), ("en", -64, 0, 0, 900), ("en", -64, 0, 1, 100),
            ("fr", -64, 0, 0, 30), ("fr", 64, 1, 0, 3)]
    bins = spark.createDataFrame(rows, "lang string, bin int, y int, fit int, n long")
    cuts = {r["lang"]: r["cut"] for r in toxicity._cuts(bins, 50, 10).collect()}
    # Unweighted, the cut would take bin 64 only (F1 16 / 27 against 20 / 39).
    assert cuts["en"] == pytest.approx((0 - 63) / 128)
    assert set(cuts) == {None, "en"}


def test_toxicity_of_messy_rows(spark, messy, no_rows):
    labels = spark.createDataFrame([(5, 1, 0), (8, 1, 1), (8, 1, 0), (12, 0, None), (None, 1, 1)] +
                                   [(20 + i, 1, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_report(messy, labels).collect()
    assert len(out) == messy.count()
    score = {}
    for r in out:  # a score depends on the text alone
        assert 0 <= r["score"] <= 1
    texts = {(r["doc_id"], r["text"]) for r in messy.select("doc_id", "text").collect()}
    for i, x in texts:
        score.setdefault(x or "", set()).update(r["score"] for r in out if r["doc_id"] == i and
                                                sum(d == i for d, _ in texts) == 1)
    assert all(len(v) <= 1 for v in score.values())
    assert {r["score"] for r in toxicity.toxicity_report(messy, labels.filter("toxic = 1")).collect()} == {0.0}
    assert toxicity.toxicity_report(no_rows, labels).collect() == []


def test_language_of_pages(spark):
    pages, docs = table(spark, SF, "pages"), table(spark, SF, "documents")
    rows = language.identify(pages, docs).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(r["page_id"] for r in pages.select("page_id").collect())
    declared = [r for r in rows if r["declared_lang"]]
    assert sum(r["lang"] == r["declared_lang"] for r in declared) / len(declared) > 0.97
    # The text alone, on documents the model may not have seen: the labels' language.
    langs, model = language.train(docs)
    sample = docs.filter("lang is not null and length(text) > 200").select("text", "lang").collect()
    ll = language.text_evidence(pa.array([r["text"] for r in sample]), model, 40)
    assert sum(langs[i] == r["lang"] for i, r in zip(ll.argmax(axis=1), sample)) / len(sample) > 0.97


def test_evidence_is_fused(spark):
    """Without text, declared language decides; without that, the host's pages."""
    docs = table(spark, SF, "documents")
    texts = {r["lang"]: r["t"] for r in docs.filter("length(text) > 400").groupBy("lang").agg(F.max("text").alias("t")).collect()}
    page = lambda x, lang=None: f"<html{f' lang={lang}' if lang else ''}><body>{x}</body></html>"
    rows = [(300 + i, "http://a.example.de/x", page(texts["de"], "de")) for i in range(30)]
    rows += [(100 + i, "http://b.example.fr/x", page(texts["fr"], "fr")) for i in range(30)]
    rows += [(1, "http://c.example.org/", page("", "fr")), (2, "http://a.example.de/y", page("12 34")),
             (3, None, None), (4, "not an address", ""), (5, "http://b.example.fr/z", page(texts["de"]))]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, post string")
    out = {r["page_id"]: r for r in language.identify(pages, docs).collect()}
    assert (out[1]["lang"], out[2]["lang"], out[5]["lang"]) == ("fr", "de", "de")
    assert out[2]["text_lang"] is None or out[2]["confidence"] < 1
    assert out[3]["lang"] is not None and out[3]["host"] is None and out[4]["host"] is None
    empty = language.identify(pages, docs.limit(0)).collect()
    assert len(empty) == len(out) == len(rows) and {r["lang"] for r in empty} == {None}
    assert language.identify(pages.limit(0), docs).collect() == []


def test_pipeline_matches_brute_force(spark):
    """Stage by stage: the same model's scores, all pairs of fingerprints, all
    windows, the patterns, the targets."""
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    model = toxicity.train(docs, table(spark, SMALL, "labels").filter(~toxicity.held_out()))
    cut = lambda lang: model.thresholds.get(lang or "", model.default_threshold)
    rows = docs.collect()
    scores = toxicity.score_texts(model, pa.array([r["text"] for r in rows], pa.large_string()))
    rows = [r for r, s in zip(rows, scores) if s < cut(r["lang"])]

    comp = brute.components([r["doc_id"] for r in rows], [brute.fingerprint(r["text"]) for r in rows])
    rows = [r for r, c in zip(rows, comp) if r["doc_id"] == c]

    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    found = brute.contamination([r["text"] for r in rows], items)
    rows = [r for r, f in zip(rows, found) if not f[-1]]

    stages, at = dict(corpus_pipeline.STAGES), docs
    for name in ("toxicity", "simhash", "decontamination"):
        at = materialise(stages[name](spark, at, SMALL), f"test-{name}")
        assert at.columns == columns
    assert sorted(map(tuple, at.collect())) == sorted(map(tuple, rows))

    masked = materialise(stages["secrets"](spark, at, SMALL), "test-secrets")
    assert masked.columns == columns
    text = {r["doc_id"]: r["text"] for r in masked.collect()}
    for r in rows:
        assert brute.secrets(text[r["doc_id"]])[:3] == (0, 0, 0)
        if "[SECRET]" not in text[r["doc_id"]]:
            assert text[r["doc_id"]] == r["text"]
        else:
            assert sum(brute.secrets(r["text"])[:3]) > 0

    final = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    sizes = {}
    for r in masked.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.TOKEN.findall(r["text"] or ""))
    want = brute.targets(sizes)
    for r in masked.collect():
        f = final.get(r["doc_id"])
        assert f is None or (f["text"], f["source_size"]) == (r["text"], sizes[r["source"]])
        assert f is None or f["target"] == pytest.approx(want[r["source"]])
    for s, t in want.items():
        assert abs(sum(f["taken"] for f in final.values() if f["source"] == s) - t) <= 24


def test_filters_judge_rows_not_ids(spark, tmp_path):
    """Null and repeated ids: only contaminated rows go, every group keeps a row."""
    item = table(spark, SMALL, "benchmark").filter("size(split(text, ' ')) > 12").first()["text"]
    other = lambda k: " ".join(f"{k}word{i}" for i in range(30))
    rows = [(None, item), (None, other("a")), (None, None), (7, item), (7, other("b")), (7, other("b")),
            (8, other("c")), (9, other("c")), (9, other("d"))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs, stages = spark.read.parquet(str(tmp_path / "d")), dict(corpus_pipeline.STAGES)
    got = lambda name: sorted(map(str, map(tuple, stages[name](spark, docs, SMALL).collect())))
    assert got("decontamination") == sorted(str(r) for r in rows if r[1] != item)
    # The two copies of the item are one group, which keeps the row with an id.
    assert got("simhash") == sorted(map(str, [(None, None), (7, item), (None, rows[1][1]), rows[4], rows[6], rows[8]]))


@pytest.mark.parametrize("n", range(4))
def test_stages_take_messy_and_empty_tables(spark, messy, no_rows, n, tmp_path):
    name, stage = corpus_pipeline.STAGES[n]
    messy.write.parquet(str(tmp_path / "m"))
    no_rows.write.parquet(str(tmp_path / "e"))
    for path in ("m", "e"):
        docs = spark.read.parquet(str(tmp_path / path))
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert (out.count() > 0) == (path == "m")


def test_operators_used_by_the_pipeline_are_the_library_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == \
        ["toxicity", "simhash", "decontamination", "secrets", "mixing"]
    for module in (toxicity, simhash, decontamination, secrets, mixing):
        assert module.__name__.startswith("shiftwise.llm.")


def test_seventy_languages_are_all_modelled(spark):
    def words(lang, n):
        return " ".join(f"{lang}{'abcdefgh'[(i * 7) % 8]}{'klmnop'[i % 6]}" for i in range(n))
    names = [f"{a}{b}" for a in "qwertyz" for b in "abcdefghij"]  # 70 codes
    docs = spark.createDataFrame([(i * 10 + j, words(n, 30 + j), n) for i, n in enumerate(names) for j in range(3)],
                                 "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(i, None, f"<p>{words(n, 25)}</p>") for i, n in enumerate(names)],
                                  "page_id long, url string, html string")
    langs, table = language.train(docs)
    assert langs == sorted(names) and table.shape[0] == 70
    out = {r["page_id"]: r["text_lang"] for r in language.identify(pages, docs).collect()}
    assert out == dict(enumerate(names))
    with pytest.raises(ValueError, match="more than 5 languages"):
        language.train(docs, max_languages=5)


def test_language_model_is_counts_of_one_row_per_id(spark):
    rows = [(1, "aa bb aa", "x"), (1, "zz", "x"), (2, None, "x"), (3, "cc " * 5000, "y"), (None, "dd", "y"), (4, "ee", None)]
    once = spark.createDataFrame([r for r in rows if r[1] != "zz"], "doc_id long, text string, lang string")
    many = spark.createDataFrame(rows + rows[:1] * 50, "doc_id long, text string, lang string").repartition(3)
    (langs, a), (_, b) = language.train(once), language.train(many)
    assert langs == ["x", "y"] and (a == b).all()


def test_repeated_ids_do_not_weigh_in_the_toxicity_fit(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    copies = docs.unionByName(docs.filter("doc_id % 3 = 0").crossJoin(spark.range(5)).drop("id"))
    first, second = (toxicity.train(d, labels) for d in (docs, copies))
    assert all((x == y).all() for x, y in zip(first.kernels, second.kernels)) and (first.embed == second.embed).all()
