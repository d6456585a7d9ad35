"""The registered queries against their DuckDB SQL and their contracts' columns."""
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duck  # noqa: E402
from early_warning.llm.queries import ORACLES, QUERIES  # noqa: E402

COLUMNS = {
    "op1_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op3_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op4_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op8_simhash": "doc_id fingerprint component_id",
    "op9_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op11_jaccard_join": "doc_id n_shingles component_id",
    "op12_spelling_variants": "word form root n n_near form_n",
    "op13_hard_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, key):
    line = compare(spark, duck(sf_dir), key, QUERIES[key], ORACLES[key], sf_dir)
    assert " OK " in line, line


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n[:2] == "op" and n[2].isdigit()} == set(range(1, 14))
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_contract_columns(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert set(COLUMNS[key].split()) <= set(df.columns)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "bigint" for c in COLUMNS[key].split() if c.startswith("n_") or c in ("size", "slot", "text_crc32", "n", "form_n")
               or c.endswith(("_id", "_score")) and c != "component_id")
