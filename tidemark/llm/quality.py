"""Quality classifier: a sparse ensemble of rules over text statistics, scored by Spark column expressions."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import each_batch, prepared, texts_of
from tidemark.session import checkpointed

# Labelled rows the model is fitted on, about so many whatever the input: a hash of the id picks them.
LABELLED = 50_000
TREES, DEPTH, LEAST_ROWS = 12, 3, 25
LASSO = 0.002


def _only(members: bytes) -> bytes:
    return bytes(set(range(256)) - set(members))


_CAPITALS, _DIGITS = _only(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _only(b"0123456789")
_MARKS, _STOPS, _SIGNS = _only(b"#$%&*+<=>@\\^_`{|}~"), _only(b".,;:"), _only(b"!?")

STATS = (
    "words", "word_length", "capitals", "digits", "marks", "stops", "signs", "bars", "line_words", "same_lines",
    "distinct_words", "longest_word", "not_ascii",
)


def text_stats(text: bytes) -> list[float]:
    """Statistics of a text, all finite; all 0 for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATS)
    n, size = len(words), sum(map(len, words))
    lines = [x for x in text.split(b"\n") if x.strip()]

    def share(others: bytes) -> float:
        return len(text.translate(None, others)) / size

    return [
        float(np.log1p(n)),
        size / n,
        share(_CAPITALS),
        share(_DIGITS),
        share(_MARKS),
        share(_STOPS),
        share(_SIGNS),
        text.count(b"|") / n,
        float(np.log1p(n / len(lines))),
        1 - len(set(lines)) / len(lines),
        len(set(words)) / n,
        float(np.log1p(max(map(len, words)))),
        1 - len(text.translate(None, bytes(range(128, 256)))) / len(text),
    ]


def document_stats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def work(batch) -> dict:
        rows = np.array([text_stats(t) for t in texts_of(batch, text_col)])
        return {id_col: batch.column(id_col)} | {k: rows[:, i] for i, k in enumerate(STATS)}

    schema = T.StructType([docs.schema[id_col], *(T.StructField(k, T.DoubleType()) for k in STATS)])
    return each_batch(docs.select(id_col, text_col), work, schema)


def paths_of(tree: str) -> list[tuple[tuple[int, str, float], ...]]:
    """Every path from the root of a printed tree to a node below it, as conditions (feature, comparison, value)."""
    found, above = [], []
    for line in tree.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = len(m[1])
            above = [(d, c) for d, c in above if d < depth] + [(depth, (int(m[2]), m[3], float(m[4])))]
            found.append(tuple(c for _, c in above))
    return found


def condition(path: tuple[tuple[int, str, float], ...]) -> Column:
    """The path as one Spark condition; of several bounds on a statistic the tightest counts."""
    bounds: dict[tuple[int, str], float] = {}
    for k, sign, value in path:
        tighter = min if sign == "<=" else max
        bounds[k, sign] = tighter(value, bounds.get((k, sign), value))
    out = F.lit(True)
    for (k, sign), value in sorted(bounds.items()):
        out = out & (F.col(STATS[k]) <= value if sign == "<=" else F.col(STATS[k]) > value)
    return out


class RuleEnsemble:
    """Weighted rules: ``score()`` is a Spark column over the statistics."""

    def __init__(self, base: float, rules: list[tuple[tuple, float]]):
        self.base, self.rules = base, rules

    def score(self) -> Column:
        total = F.lit(self.base)
        for path, weight in self.rules:
            total = total + F.when(condition(path), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(rows: DataFrame) -> RuleEnsemble:
    """Trees propose rules, lasso logistic regression weighs them. ``rows``: the statistics and ``label`` (0, 1)."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(known) < 2:
        odds = (known.get(1.0, 0) + 1) / (known.get(0.0, 0) + 1)
        return RuleEnsemble(float(np.log(odds)), [])
    vectors = VectorAssembler(inputCols=list(STATS), outputCol="stats").transform(rows)
    forest = RandomForestClassifier(
        featuresCol="stats", labelCol="label", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=LEAST_ROWS,
        featureSubsetStrategy="0.5", seed=11,
    ).fit(vectors)
    paths = sorted({p for tree in forest.trees for p in paths_of(tree.toDebugString)})
    if not paths:
        return RuleEnsemble(float(np.log(known[1.0] / known[0.0])), [])
    hits = checkpointed(
        rows.select("label", *(condition(p).cast("double").alias(f"r{i}") for i, p in enumerate(paths)))
    )
    hits = VectorAssembler(inputCols=[f"r{i}" for i in range(len(paths))], outputCol="rules").transform(hits)
    lasso = LogisticRegression(
        featuresCol="rules", labelCol="label", elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False
    ).fit(hits)
    weights = lasso.coefficients.toArray().tolist()
    return RuleEnsemble(float(lasso.intercept), [(p, w) for p, w in zip(paths, weights) if w])


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.5,
) -> DataFrame:
    """One row per document: ``id``, its statistics, ``score`` and ``predicted``.

    ``labels`` (id, label) are all that is learned from; only texts are scored. Statistics are read once from the texts
    and written to the shared folder; labels meet them there, so texts are never shuffled.

    Null or empty text: all statistics 0, scored by the rules that hold for them. Null labels or ids are not learned
    from; of several labels of a document the largest counts. One label value only: its share is every score. Null id:
    scored like any other. Empty input: no rows.
    """
    prepared(docs.sparkSession)
    stats = checkpointed(document_stats(docs, id_col, text_col))
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("double").alias("label"))
    share = min(1.0, LABELLED / max(1, known.count()))
    some = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    model = fit(checkpointed(stats.join(some, F.col(id_col) == F.col("_id")).select("label", *STATS)))
    scored = stats.withColumn("score", model.score())
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
