"""The registered queries: names, columns of the contracts, whole tables."""

import __spark_entry__ as E
import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_licenses": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op2_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op3_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op4_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5_mixing": "doc_id size source_size target taken",
    "op6_simhash": "doc_id fingerprint component_id",
    "op7_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op8_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op9_toxicity": "doc_id held_out score predicted",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, name):
    out = E.queries()[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(out.columns)
    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == ids


def test_native_operators_plan_no_python(spark):
    for name in ("op1_licenses", "op3_fingerprints", "op7_secrets"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name
