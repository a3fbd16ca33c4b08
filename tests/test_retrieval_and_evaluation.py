import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.helpers import bag
from tidemark.functions.ordering import numbered, values_at
from tidemark.operators import cost, evaluation, retrieval, runs


def vectors(spark, n, seed, name):
    rng = np.random.default_rng(seed)
    rows = [(i, f"g{i % 7}", [float(x) for x in rng.normal(size=8)]) for i in range(n)]
    rows += [(n, "g0", rows[0][2]), (n + 1, "g1", rows[0][2])]  # exact ties
    return rows, spark.createDataFrame(rows, f"{name}_id bigint, doc_group string, embedding array<float>").repartition(5)


def brute_force(queries, docs, n):
    out = []
    for qid, _, q in queries:
        scored = []
        for did, group, d in docs:
            a, b = np.float32(q).astype(float), np.float32(d).astype(float)
            scored.append((-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9), did, group))
        out += [(qid, did, group, rank + 1) for rank, (_, did, group) in enumerate(sorted(scored)[:n])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_bytes", [32 << 20, 200], ids=["one slice", "several slices"])
def test_vector_search_is_exact(spark, slice_bytes, monkeypatch):
    monkeypatch.setattr(retrieval, "QUERY_BYTES", slice_bytes)
    q_rows, q = vectors(spark, 15, 1, "query")
    d_rows, d = vectors(spark, 200, 2, "doc")
    found = retrieval.vector_topk_docs(q, d, 6)
    assert bag(found.select("query_id", "doc_id", "doc_group", "rank")) == brute_force(q_rows, d_rows, 6)


def test_many_queries_stay_fast_and_small():
    """4,096 queries against 10,000 documents: one task's work."""
    rng = np.random.default_rng(1)
    queries = retrieval._unit_rows(rng.normal(size=(4096, 64)))
    docs = pd.DataFrame({"doc_id": np.arange(10_000), "doc_group": "g", "embedding": list(rng.normal(size=(10_000, 64)))})
    run = retrieval._score_against(np.arange(4096), queries, 10)
    tracemalloc.start()
    (out,) = run(iter([docs]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 40_960 and peak < 300 << 20
    best = (retrieval._unit_rows(docs["embedding"]) @ queries[7]).round(9)
    assert out[out["query_id"] == 7]["doc_id"].tolist() == np.lexsort((docs["doc_id"], -best))[:10].tolist()


def test_documents_are_not_shuffled_for_few_queries(spark):
    _, q = vectors(spark, 3, 1, "query")
    d = spark.range(100).select(
        F.col("id").alias("doc_id"), F.lit("g").alias("doc_group"), F.array(*[F.rand(i) for i in range(8)]).alias("embedding")
    )
    plan = retrieval.vector_topk_docs(q, d, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "WindowGroupLimit" in plan


def test_groups_score_as_their_best_document(spark):
    near = spark.createDataFrame(
        [(1, 10, "a", 0.9), (1, 11, "b", 0.8), (1, 12, "a", 0.95), (1, 13, "c", -0.5)],
        "query_id bigint, doc_id bigint, doc_group string, score double",
    )
    assert bag(retrieval.vector_topk_groups(near, 2).select("doc_group", "score", "rank")) == [
        ("a", 0.95, 1),
        ("b", 0.8, 2),
    ]
    assert bag(retrieval.vector_topk_groups(near, 3).filter("rank = 3").select("doc_group", "score")) == [("c", 0.0)]


def test_keyword_search_needs_every_word(spark):
    df = spark.createDataFrame([(1, "Daily GMV", "per day"), (2, "users", "City of user")], "id int, a string, b string")
    assert [r["id"] for r in retrieval.keyword_search(df, ["a", "b"], " gmv DAY ").collect()] == [1]
    assert retrieval.keyword_search(df, ["a", "b"], "").count() == 2


def test_documents_never_name_tagged_columns(spark):
    rows = [("raw.users", "table", "Payers. One row each.", c, f"the {c}", p) for c, p in (("city", False), ("phone", True))]
    schema = "table_key string, kind string, table_description string, column_name string, description string, pii boolean"
    docs = retrieval.build_docs(spark.createDataFrame(rows, schema)).collect()
    assert sorted(d["content"] for d in docs) == [
        "column city of raw.users (Payers): the city",
        "table raw.users: Payers. One row each. Columns: city",
    ]


def test_recall(spark):
    rows = [(["a"], ["a", "b", "c"]), (["a", "d"], ["b", "a", "c", "d"]), (["z"], ["a"])]
    df = spark.createDataFrame(rows, "gold array<string>, retrieved array<string>")
    assert bag(retrieval.recall_at_k(df)) == [
        (1, 3, 0.333, 0.333, 0.333),
        (3, 3, 0.5, 0.333, 0.667),
        (5, 3, 0.667, 0.667, 0.667),
    ]


def equal(spark, left, right, schema="a double, b string"):
    frames = [spark.createDataFrame(rows, schema) for rows in (left, right)]
    return evaluation.multiset_equal(*frames).first()["equal"]


def test_result_sets(spark):
    rows = [(1.004, "x"), (2.0, None), (2.0, None)]
    assert equal(spark, rows, [(2.0, None), (1.0, "x"), (2.0, None)])
    assert not equal(spark, rows, rows[:2])
    assert not equal(spark, rows, [(1.02, "x"), *rows[1:]])
    assert equal(spark, [], []) and not equal(spark, rows, [])
    assert equal(spark, [(1.0, 2.0)], [(2.0, 1.0)], "a double, b double")  # by design


def test_order_only_difference(spark):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    up, down = [F.col("id")], [F.col("id").desc()]
    row = evaluation.order_only_difference(df, df, up, down).first()
    assert (row["equal_in_order"], row["equal_as_bag"], row["order_only"]) == (False, True, True)
    row = evaluation.order_only_difference(df, df, up, up).first()
    assert (row["equal_in_order"], row["equal_as_bag"], row["order_only"]) == (True, True, False)


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert bag(numbered(df, [F.col("v").desc()], "at")) == sorted([(v, 999 - v) for v in range(1000)], key=repr)


def test_order_statistics_with_a_dominant_group_and_value(spark):
    rng = random.Random(5)
    values = {"hot": [rng.choice([1.0, 2.0, rng.random() * 1e9]) for _ in range(3000)], "small": [5.0], "two": [1.0, 3.0]}
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("two", None), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    found = {r["k"]: tuple(r)[1:] for r in cost.latency_percentiles(df, "v", ["k"]).collect()}
    for k, vs in values.items():
        ordered, n = sorted(vs), len(vs)
        assert found[k] == (n, *[ordered[min(n - 1, p * n // 100)] for p in (50, 95, 99)])
    assert "none" not in found
    first = values_at(df, "v", [], {"first": F.lit(0), "last": F.col("n") - 1}).first()
    assert (first["first"], first["last"]) == (min(sum(values.values(), [])), max(sum(values.values(), [])))


def test_median_leaves_the_warm_up_out(spark):
    rows = [("q", 0, 99.0), ("q", 1, 3.0), ("q", 2, 1.0), ("q", 3, 2.0), ("r", 0, 1.0), ("r", 1, 4.0), ("r", 2, 5.0)]
    df = spark.createDataFrame(rows, "label string, run int, ms double")
    assert bag(cost.bench_median(df, "ms", "run", ["label"])) == [("q", 3, 2.0, 1.0), ("r", 2, 4.5, 4.0)]


def test_latest_runs_put_missing_starts_last(spark):
    rows = [("j", i, None if i == 3 else f"2026-01-0{i + 1} 00:00:00", "success") for i in range(4)]
    df = spark.createDataFrame(rows, "job string, run_id int, start string, state string")
    df = df.withColumn("start", F.col("start").cast("timestamp_ntz"))
    assert [r["run_id"] for r in runs.latest_runs(df, 4).orderBy("recency").collect()] == [2, 1, 0, 3]
    plan = runs.latest_runs(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def record(spark, **changes):
    base = dict(
        error="", guard_ok=True, guard_errors=[], exec_error="", correct=False, gold_tables=["a"], retrieved=["a"], used_tables=["a"]
    )
    schema = (
        "error string, guard_ok boolean, guard_errors array<string>, exec_error string, correct boolean, "
        "gold_tables array<string>, retrieved array<string>, used_tables array<string>"
    )
    row = base | changes
    df = spark.createDataFrame([tuple(row[c.split()[0]] for c in schema.split(", "))], schema)
    return evaluation.classify_outcomes(df).first()["outcome"]


@pytest.mark.parametrize(
    "changes, outcome",
    [
        (dict(correct=True), "correct"),
        (dict(error="x", correct=True), "pipeline_error"),
        (dict(guard_ok=None), "guard:other"),
        (dict(guard_ok=False, guard_errors=["LIMIT", "PII"]), "guard:missing_or_bad_limit"),
        (dict(guard_ok=False, guard_errors=["estimated scan"]), "guard:cost_gate"),
        (dict(exec_error="x"), "execution_error"),
        (dict(retrieved=["b"]), "wrong_result:retrieval_missed_a_gold_table"),
        (dict(used_tables=["a", "b"]), "wrong_result:wrong_table_choice"),
        (dict(), "wrong_result:same_tables_wrong_logic"),
    ],
)
def test_outcomes(spark, changes, outcome):
    assert record(spark, **changes) == outcome


def test_scan_estimate_fails_closed(spark):
    manifest = spark.createDataFrame(
        [("t", "2026-01-01", 10), ("t", "2026-01-03", 30)], "table_name string, dt string, rows bigint"
    )
    asked = [
        ("all", "t", None, None),
        ("gap", "t", "2026-01-02", "2026-01-02"),
        ("late", "t", "2026-01-02", None),
        ("reversed", "t", "2026-01-03", "2026-01-01"),
        ("beyond", "t", "2027-01-01", None),
        ("unknown", "u", None, None),
    ]
    requests = spark.createDataFrame(asked, "request_id string, table_name string, dt_from string, dt_to string")
    found = {r["request_id"]: tuple(r)[2:] for r in cost.scan_estimate(manifest, requests, 35).collect()}
    assert found == {
        "all": (40, 2, "over_limit"),
        "gap": (0, 0, "ok"),
        "late": (30, 1, "ok"),
        "reversed": (0, 0, "ok"),
        "beyond": (0, 0, "ok"),
        "unknown": (0, 0, "unknown_statistics"),
    }


def test_storage_growth(spark):
    manifest = spark.createDataFrame(
        [("t", "d2", 3, 10), ("t", "d1", 4, 10)], "table_name string, dt string, rows bigint, bytes bigint"
    )
    assert bag(cost.storage_growth(manifest)) == [("t", "d1", 4, 10, 10, 2.5), ("t", "d2", 3, 10, 20, 3.33)]
