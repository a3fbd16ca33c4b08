"""Exact vector search that skips blocks of documents by their distances to pivots.

For unit vectors, cosine = 1 - distance**2 / 2, and distances obey the triangle inequality: if a query lies at D from a pivot
and all documents of a block between low and high, no document of it is nearer to the query than D - high or low - D.
The best of these bounds over all pivots tells the highest score the block can hold.

The index holds every document with its distances to all pivots, ordered by its nearest pivot and the distance to it. A
search first scans the neighbourhood of each query's nearest pivot, which gives a score its answers have to
reach, and then the blocks that can reach it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.retrieval import _RESULT, _SCORE_DIGITS, SCORE_BYTES, _first, _query_slices, _ranked, _unit_rows
from tidemark.session import scratch_path, small_frame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS = 32
# Documents, in the order of a hash of their ids, among which pivots are looked for.
SAMPLE = 4096
BLOCK = 256
# Distances are stored as floats, scores compared at nine digits.
_SLACK = 1e-5

_STORED = "doc_id bigint, doc_group string, embedding array<double>, home int, away array<float>"
_FOUND = _RESULT + ", pairs bigint, skipped bigint"


@dataclass(frozen=True)
class PivotIndex:
    path: str
    pivots: np.ndarray

    def rows(self, spark) -> DataFrame:
        return spark.read.schema(_STORED).parquet(self.path)


def _distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (units**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * units @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    chosen = [0]
    reach = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)):
        at = int(reach.argmax())
        if reach[at] <= _SLACK:
            break
        chosen.append(at)
        reach = np.minimum(reach, _distances(sample, sample[at : at + 1])[:, 0])
    return sample[chosen]


def build_pivot_index(docs: DataFrame, pivots: int = PIVOTS, path: str | None = None, parts: int | None = None) -> PivotIndex:
    """Index ``doc_id, doc_group, embedding``; rows without a vector are left out, as no search can return them.

    Pivots come from ``SAMPLE`` documents whatever the input; every document is indexed.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("doc_group").cast("string").alias("doc_group"), F.col("embedding").cast("array<double>"))
    docs = docs.filter(F.col("embedding").isNotNull())
    few = docs.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select("embedding").collect()
    centres = choose_pivots(_unit_rows(r["embedding"] for r in few), pivots) if few else np.zeros((0, 0))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = _distances(_unit_rows(batch["embedding"]), centres)
                yield batch.assign(home=away.argmin(axis=1), away=list(away.astype(np.float32)))

    placed = docs.mapInPandas(place, _STORED) if few else spark.createDataFrame([], _STORED)
    path = path or scratch_path(spark, "pivot-index")
    order = ["home", F.col("away")[F.col("home")], F.col("doc_id")]
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed.repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(path)
    return PivotIndex(path, centres)


def _search(ids: np.ndarray, queries: np.ndarray, index: PivotIndex, n: int, reach: np.ndarray | None):
    """Task function over index rows: the best ``n`` of its rows per query, and how many (block, query) pairs it skipped.

    Without ``reach``, the scores to be reached, a block is compared with the queries of its own pivot.
    """
    centres = index.pivots
    away = _distances(queries, centres)
    home = away.argmin(axis=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, pairs, skipped = pd.DataFrame(columns=["query_id", "doc_id", "doc_group", "score"]), 0, 0
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                docs = batch.iloc[at : at + BLOCK]
                if reach is None:
                    asked = np.flatnonzero(np.isin(home, docs["home"].unique()))
                else:
                    own = np.stack(docs["away"].to_numpy())
                    gap = np.maximum(away - own.max(axis=0), own.min(axis=0) - away).max(axis=1) - _SLACK
                    best = 1 - np.maximum(gap, 0) ** 2 / 2
                    asked = np.flatnonzero(best >= reach - _SLACK)
                pairs, skipped = pairs + len(ids), skipped + len(ids) - len(asked)
                if not len(asked):
                    continue
                matrix, found = _unit_rows(docs["embedding"]), []
                width = max(1, SCORE_BYTES // (8 * len(docs)))
                for q in range(0, len(asked), width):
                    some = asked[q : q + width]
                    scores = np.round(matrix @ queries[some].T, _SCORE_DIGITS)
                    least = np.partition(scores, max(0, len(docs) - n), axis=0)[max(0, len(docs) - n)]
                    doc, query = np.nonzero(scores >= least)
                    rows = {
                        "query_id": ids[some[query]],
                        "doc_id": docs["doc_id"].to_numpy()[doc],
                        "doc_group": docs["doc_group"].to_numpy(dtype=object)[doc],
                        "score": scores[doc, query],
                    }
                    found.append(pd.DataFrame(rows))
                kept = _first(pd.concat([*([kept] if len(kept) else []), *found], ignore_index=True), n)
        if len(kept):
            yield kept.assign(pairs=0, skipped=0)
        yield pd.DataFrame([{"query_id": None, "doc_id": None, "doc_group": None, "score": None, "pairs": pairs, "skipped": skipped}])

    return run


def pivot_topk_docs(queries: DataFrame, index: PivotIndex, n_docs: int) -> tuple[DataFrame, DataFrame]:
    """The ``n_docs`` nearest documents of each query, exact, as :func:`retrieval.vector_topk_docs` has them, and a frame
    with one row: ``pairs`` of blocks and queries, those ``skipped`` by their bounds.

    Queries without a vector have no answer. The scores to be reached pass the driver, one number per query of a slice.
    """
    spark, found = queries.sparkSession, None
    queries = queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding"))
    for ids, matrix in _query_slices(queries.filter(F.col("embedding").isNotNull())):
        if not len(index.pivots):
            break
        near = index.rows(spark).mapInPandas(_search(ids, matrix, index, n_docs, None), _FOUND)
        ranked = _ranked(near.filter("query_id IS NOT NULL"), ["query_id"], ["doc_id"], n_docs)
        last = ranked.filter(F.col("rank") == n_docs).select("query_id", "score").toArrow()
        known = dict(zip(last.column("query_id").to_pylist(), last.column("score").to_pylist()))
        reach = np.array([known.get(i, -np.inf) for i in ids.tolist()])
        path = scratch_path(spark, "pivot-search")
        index.rows(spark).mapInPandas(_search(ids, matrix, index, n_docs, reach), _FOUND).write.parquet(path)
        part = spark.read.schema(_FOUND).parquet(path)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return small_frame(spark, [], _RESULT + ", rank int"), small_frame(spark, [(0, 0)], "pairs bigint, skipped bigint")
    best = found.filter("query_id IS NOT NULL").select("query_id", "doc_id", "doc_group", "score")
    some = F.pmod(F.xxhash64("doc_id"), F.lit(16))
    first = _ranked(best.withColumn("_some", some), ["query_id", "_some"], ["doc_id"], n_docs).drop("_some", "rank")
    counts = found.agg(F.sum("pairs").alias("pairs"), F.sum("skipped").alias("skipped"))
    return _ranked(first, ["query_id"], ["doc_id"], n_docs), counts
