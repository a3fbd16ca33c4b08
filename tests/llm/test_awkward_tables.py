"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import pytest

import corpus_pipeline
from tests.llm.helpers import awkward_rows, docs_frame
from tidemark.llm import (
    decontamination,
    hosts,
    language,
    mixing,
    passages,
    quality,
    simhash,
    substrings,
    tokens,
    toxicity,
)
from tidemark.llm.queries import tokenizer_path


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


LABELS = [(4, 1, 0), (7, 0, 1), (7, 1, 0), (None, 1, 1), (8, None, None), (20, 0, 1), (21, 1, 0), (99, 1, 1)]
ITEMS = [(0, None), (1, ""), (2, "w1 w2 w3"), (None, "W3, w1!"), (3, "-- !"), (2, "w1 w2 w3")]

OPERATORS = {
    "hosts": lambda spark, d, lab, b: hosts.host_rules(d),
    "substrings": lambda spark, d, lab, b: substrings.deduplicate(d, keep=("lang",)),
    "tokens": lambda spark, d, lab, b: tokens.token_counts(d, tokenizer_path(), 2048),
    "passages": lambda spark, d, lab, b: passages.near_passages(d),
    "decontamination": lambda spark, d, lab, b: decontamination.decontaminate(d, b, keep=("source",)),
    "simhash": lambda spark, d, lab, b: simhash.near_duplicates(d),
    "toxicity": lambda spark, d, lab, b: toxicity.score(d, lab, keep=("lang",)),
    "language": lambda spark, d, lab, b: language.identify(d, d, keep=("source",)),
    "quality": lambda spark, d, lab, b: quality.score(d, lab),
    "mixing": lambda spark, d, lab, b: mixing.mix(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_give_a_row_each(spark, name):
    rows = awkward_rows()
    d = docs_frame(spark, rows, clashing=True)
    benchmark = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    out = OPERATORS[name](spark, d, labels(spark, LABELS), benchmark).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(d) for d, *_ in rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_no_rows(spark, name):
    d = docs_frame(spark, [])
    benchmark = spark.createDataFrame([], "item_id bigint, text string")
    assert OPERATORS[name](spark, d, labels(spark, []), benchmark).collect() == []


def test_unlabelled_and_without_items(spark):
    d = docs_frame(spark, awkward_rows())
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r["contaminated"] for r in decontamination.decontaminate(d, none).collect())
    assert all(r["score"] < 0.3 for r in toxicity.score(d, labels(spark, [])).collect())
    assert {r["lang_pred"] for r in language.identify(d, d.filter("false")).collect()} == {"und"}


@pytest.mark.parametrize("rows", [awkward_rows(), []], ids=["awkward", "empty"])
def test_stages(spark, tmp_path, rows):
    docs_frame(spark, rows, clashing=False).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.schema == docs.schema, name
    taken = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(0 < r["taken"] <= 3 * r["size"] for r in taken)
