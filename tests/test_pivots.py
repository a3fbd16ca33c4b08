"""Vector search with skipped blocks next to the full product."""

import numpy as np
import pytest

from tests.helpers import bag
from tidemark.operators import pivots, retrieval

DOCS = "doc_id bigint, doc_group string, embedding array<double>"
QUERIES = "query_id bigint, embedding array<double>"


def clustered(rng, n, clusters=12, dims=24, spread=0.05):
    centres = rng.normal(size=(clusters, dims))
    return [(centres[i % clusters] + spread * rng.normal(size=dims)).tolist() for i in range(n)]


def both(spark, docs, queries, n, **how):
    d, q = spark.createDataFrame(docs, DOCS), spark.createDataFrame(queries, QUERIES)
    out, counts = pivots.pivot_topk_docs(q, pivots.build_pivot_index(d, **how), n)
    return bag(out), bag(retrieval.vector_topk_docs(q, d, n)), counts.first()


@pytest.mark.parametrize("n", [1, 5, 40])
def test_equals_the_full_product_and_skips(spark, n):
    rng = np.random.default_rng(1)
    vectors = clustered(rng, 4000)
    docs = [(i, f"g{i % 7}", v) for i, v in enumerate(vectors)]
    queries = [(i, vectors[i]) for i in range(0, 4000, 50)]
    out, expected, counts = both(spark, docs, queries, n, parts=4)
    assert out == expected and len(out) == n * len(queries)
    assert counts["skipped"] > 0.5 * counts["pairs"]


def test_vectors_without_structure_lose_nothing(spark):
    rng = np.random.default_rng(2)
    docs = [(i, "g", rng.normal(size=16).tolist()) for i in range(1500)]
    queries = [(i, rng.normal(size=16).tolist()) for i in range(40)]
    out, expected, counts = both(spark, docs, queries, 10)
    assert out == expected


def test_ties_nulls_zeros_and_copies(spark):
    rng = np.random.default_rng(3)
    some = clustered(rng, 30, 3, 8)
    docs = [(i, None if i % 5 == 0 else "g", some[i % 30]) for i in range(900)]
    docs += [(2000, "g", None), (2001, "g", [0.0] * 8), (2002, "g", [0.0] * 8)]
    queries = [(1, some[0]), (2, [0.0] * 8), (3, None), (4, [-x for x in some[1]])]
    out, expected, _ = both(spark, docs, queries, 20)
    assert out == expected and {r[0] for r in out} == {1, 2, 4}


def test_fewer_documents_than_asked_for_and_none(spark):
    rng = np.random.default_rng(4)
    docs = [(i, "g", v) for i, v in enumerate(clustered(rng, 6, 2, 4))]
    queries = [(1, docs[0][2])]
    out, expected, _ = both(spark, docs, queries, 10)
    assert out == expected and len(out) == 6
    assert both(spark, [], queries, 3)[0] == [] and both(spark, docs, [], 3)[0] == []


def test_slices_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = clustered(rng, 600, 6, 8)
    docs = [(i, "g", v) for i, v in enumerate(vectors)]
    queries = [(i, vectors[i]) for i in range(0, 600, 20)]
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 8 * 8 * 7)
    out, expected, _ = both(spark, docs, queries, 4)
    assert out == expected


def test_pivots_are_far_apart():
    rng = np.random.default_rng(6)
    units = retrieval._unit_rows(clustered(rng, 300, 5, 8, 0.001))
    chosen = pivots.choose_pivots(units, 5)
    apart = pivots._distances(chosen, chosen) + 9 * np.eye(5)
    assert apart.min() > 0.3
    assert len(pivots.choose_pivots(np.repeat(units[:1], 50, axis=0), 5)) == 1
