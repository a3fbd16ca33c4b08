"""Discovery: catalog documents, exact vector search, keyword search, retrieval quality."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed, small_frame

# The task functions below travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BYTES = 32 << 20  # query vectors that are sent to the tasks at a time
SCORE_BYTES = 16 << 20  # one matrix of scores inside a task
_SCORE_DIGITS = 9  # ranks compare scores at this precision, so equal vectors tie exactly


def build_docs(columns: DataFrame) -> DataFrame:
    """One document per table and one per column that is not PII.

    ``columns`` has one row per column: ``table_key, kind, table_description, column_name, description,
    pii``. Names of tagged columns appear nowhere. Any number of tables: the grouping is per table, and a
    table has a bounded number of columns.
    """
    safe = columns.filter(~F.col("pii"))
    tables = (
        safe.groupBy("table_key", "kind", "table_description")
        .agg(F.array_sort(F.collect_set("column_name")).alias("names"))
        .select(
            "table_key",
            F.lit(None).cast("string").alias("column_name"),
            F.concat(
                "kind",
                F.lit(" "),
                "table_key",
                F.lit(": "),
                "table_description",
                F.lit(" Columns: "),
                F.array_join("names", ", "),
            ).alias("content"),
        )
    )
    first_sentence = F.element_at(F.split("table_description", r"\."), 1)
    per_column = safe.select(
        "table_key",
        "column_name",
        F.concat(
            F.lit("column "),
            "column_name",
            F.lit(" of "),
            "table_key",
            F.lit(" ("),
            first_sentence,
            F.lit("): "),
            "description",
        ).alias("content"),
    )
    return tables.unionByName(per_column)


def _unit_rows(vectors) -> np.ndarray:
    matrix = np.asarray(list(vectors), dtype=np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


_RESULT = "query_id bigint, doc_id bigint, doc_group string, score double"
_COLUMNS = ["query_id", "doc_id", "doc_group", "score"]


def _first(rows: pd.DataFrame, n: int) -> pd.DataFrame:
    """The ``n`` best rows of every query."""
    rows = rows.iloc[np.lexsort((rows["doc_id"], -rows["score"], rows["query_id"]))]
    return rows[rows.groupby("query_id", sort=False).cumcount() < n]


def _score_against(query_ids: np.ndarray, queries: np.ndarray, n: int):
    """Task function for documents: keeps the running best ``n`` per query and emits only those.

    Scores are computed for slices of documents and queries whose matrix stays within ``SCORE_BYTES``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = pd.DataFrame(columns=_COLUMNS)
        for batch in batches:
            for at in range(0, len(batch), 4096):
                docs = batch.iloc[at : at + 4096]
                matrix, found = _unit_rows(docs["embedding"]), []
                width = max(1, SCORE_BYTES // (8 * len(docs)))
                for q in range(0, len(query_ids), width):
                    scores = np.round(matrix @ queries[q : q + width].T, _SCORE_DIGITS)
                    # The n-th best score of a query; what ties with it stays until ids decide.
                    least = np.partition(scores, max(0, len(docs) - n), axis=0)[max(0, len(docs) - n)]
                    doc, query = np.nonzero(scores >= least)
                    rows = pd.DataFrame(
                        {
                            "query_id": query_ids[q + query],
                            "doc_id": docs["doc_id"].to_numpy()[doc],
                            "doc_group": docs["doc_group"].to_numpy(dtype=object)[doc],
                            "score": scores[doc, query],
                        }
                    )
                    found.append(_first(rows, n))
                kept = _first(pd.concat([*([kept] if len(kept) else []), *found], ignore_index=True), n)
        if len(kept):
            yield kept

    return run


def _query_slices(queries: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Query ids and unit vectors, ``QUERY_BYTES`` at a time; the driver holds one slice."""
    ids, vectors, held = [], [], 0
    for query_id, vector in queries.toLocalIterator():
        ids.append(query_id)
        vectors.append(vector)
        held += 8 * len(vector)
        if held >= QUERY_BYTES:
            yield np.array(ids, dtype=np.int64), _unit_rows(vectors)
            ids, vectors, held = [], [], 0
    if ids:
        yield np.array(ids, dtype=np.int64), _unit_rows(vectors)


def vector_topk_docs(queries: DataFrame, docs: DataFrame, n_docs: int) -> DataFrame:
    """The ``n_docs`` nearest documents of each query by cosine, exact, ties by document id.

    ``queries``: ``query_id, embedding``. ``docs``: ``doc_id, doc_group, embedding``.

    Queries go to where the documents are, a slice of bounded size at a time: documents are scanned once per slice and
    never shuffled, and each task returns its best ``n_docs`` per query. These are ranked in two steps, so that the tasks'
    answers to one query do not all meet at once.
    """
    docs = docs.select("doc_id", F.col("doc_group").cast("string").alias("doc_group"), "embedding")
    docs = docs.filter(F.col("embedding").isNotNull())
    queries = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull())
    partial = None
    for ids, matrix in _query_slices(queries):
        part = docs.mapInPandas(_score_against(ids, matrix, n_docs), _RESULT)
        # A slice is answered before the next one is fetched.
        partial = part if partial is None else checkpointed(partial.unionByName(part))
    if partial is None:
        return small_frame(docs.sparkSession, [], _RESULT + ", rank int")
    some = F.pmod(F.xxhash64("doc_id"), F.lit(16))
    first = _ranked(partial.withColumn("_some", some), ["query_id", "_some"], ["doc_id"], n_docs)
    return _ranked(first.drop("_some", "rank"), ["query_id"], ["doc_id"], n_docs)


def _ranked(df: DataFrame, by: list[str], tie: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), *tie)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def vector_topk_groups(nearest: DataFrame, k: int) -> DataFrame:
    """The ``k`` best groups per query from :func:`vector_topk_docs`; a group scores as its best document,
    not below zero. Scores have four decimals."""
    best = nearest.groupBy("query_id", "doc_group").agg(
        F.greatest(F.max("score"), F.lit(0.0)).alias("score")
    )
    return _ranked(best, ["query_id"], ["doc_group"], k).withColumn("score", F.round("score", 4))


def keyword_search(df: DataFrame, texts: list[str], query: str) -> DataFrame:
    """Rows whose joined, lower-cased text contains every word of the query; an empty query keeps all."""
    hay = F.lower(F.concat_ws(" ", *texts))
    for word in query.lower().split():
        df = df.filter(F.contains(hay, F.lit(word)))
    return df


def recall_at_k(results: DataFrame, ks: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """Retrieval quality per ``k``: mean share of gold items found, and how often all or any were.

    ``results`` has one row per question: ``gold`` and ``retrieved``, arrays of keys, best first.
    """
    measures = []
    for k in ks:
        found = F.size(F.array_intersect("gold", F.slice("retrieved", 1, k)))
        wanted = F.size(F.array_distinct("gold"))
        measures.append(
            F.struct(
                F.lit(k).cast("bigint").alias("k"),
                (found / wanted).alias("share"),
                (found == wanted).cast("int").alias("all_found"),
                (found > 0).cast("int").alias("any_found"),
            )
        )
    rows = results.select(F.explode(F.array(*measures)).alias("m")).select("m.*")
    return rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("questions"),
        F.round(F.avg("share"), 3).alias("recall"),
        F.round(F.avg("all_found"), 3).alias("all_gold"),
        F.round(F.avg("any_found"), 3).alias("any_gold"),
    )
