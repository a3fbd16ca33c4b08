"""The registered queries of the package next to their SQL, and their columns."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tidemark.llm import queries

COLUMNS = {
    "op1_host_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op4_near_passages": "doc_id class_id n_links linked",
    "op5_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op6_simhash": "doc_id fingerprint component_id",
    "op7_toxicity": "doc_id held_out score predicted",
    "op8_language": "doc_id held_out lang_pred score",
    "op9_quality": "doc_id held_out score predicted",
    "op10_mixing": "doc_id size source_size target taken",
    "op11_minhash": "doc_id n_shingles component_id kept",
    "op12_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_alignment": "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}
# Nodes of a trie, not documents.
OTHER_ROWS = {"op12_prefix_trie"}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, sf_small, name):
    assert differences(queries.QUERIES[name](spark, sf_small), connect(sf_small), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_columns_and_rows(spark, sf_small, name):
    out = entry.queries()[name](spark, sf_small)
    assert set(COLUMNS[name].split()) <= set(out.columns)
    assert name in OTHER_ROWS or out.count() == spark.read.parquet(f"{sf_small}/documents.parquet").count()


def test_pipeline_is_registered():
    assert "pipeline" in entry.queries()
