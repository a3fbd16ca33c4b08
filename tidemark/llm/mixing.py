"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, comparable_id, prepared, running_sums
from tidemark.session import checkpointed, small_frame

REPEATS = 3
SEED = "mix"


def shares(sizes: dict[str | None, int], weights: tuple[int, ...] = (1, 2, 3), repeats: int = REPEATS) -> dict:
    """Target words of each source: all words shared by weight, none above ``repeats`` times its own.

    Sources in code point order, null last, take ``weights`` in turn. What a capped source cannot take is
    shared among the others by weight. Whole numbers until the one division, so the order of sources changes nothing.
    """
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    targets = {}
    rest, open_weight = sum(sizes.values()), sum(weight.values())
    for s in sorted(names, key=lambda s: (repeats * sizes[s] / weight[s], names.index(s))):
        if weight[s] * rest > repeats * sizes[s] * open_weight:
            targets[s] = float(repeats * sizes[s])
            rest, open_weight = rest - repeats * sizes[s], open_weight - weight[s]
        else:
            targets |= {x: weight[x] * rest / open_weight for x in names if x not in targets}
            break
    return targets


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    repeats: int = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``id, size, source, source_size, target, taken``.

    Documents of a source stand in a shuffled order (md5 of seed and id); after its last document a source starts
    again, up to ``repeats`` times. A copy's virtual finish time is the number of words its source has
    queued up to and with it, divided by the source's target. All copies are range-sorted by finish time over all
    tasks and taken while their words fit the budget, the sum of all words.

    Null or empty text: size and taken 0. Null source: a source of its own, last. Null id: shuffled as the empty
    string. Ties follow source, md5, id and size; repeated rows are taken one by one. Empty input: no rows. The
    source table (one row per source, each with its own weight) passes through the driver.
    """
    spark = prepared(docs.sparkSession)
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(text_col).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")).cast("binary")).alias("key"),
        comparable_id(id_col).alias("tie"),
    )
    sized = checkpointed(sized)
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    sizes = {r["source"]: r["n"] for r in totals}
    targets = shares(sizes, weights, repeats)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    table = small_frame(
        spark,
        [(i, s, sizes[s], targets[s]) for i, s in enumerate(names)],
        "rank int, source string, source_size bigint, target double",
    )
    rows = sized.join(table.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    queued = checkpointed(
        running_sums(rows.drop("_source"), ["rank", "key", "tie", "size"], "size", "rank", "queued").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    upto = F.col("round") * F.col("source_size") + F.col("queued")
    copies = (
        queued.filter("size > 0")
        .select("row", "rank", "key", "tie", "size", "source_size", "queued", "target")
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .filter(upto - F.col("size") < F.col("target"))
        .select("row", "rank", "key", "tie", "round", "size", (upto / F.col("target")).alias("finish"))
    )
    ordered = running_sums(copies, ["finish", "rank", "round", "key", "tie", "size"], "size", None, "words")
    taken = ordered.filter(F.col("words") <= sum(sizes.values())).groupBy("row").agg(F.sum("size").alias("taken"))
    return queued.join(taken, "row", "left").select(
        F.col("id").alias(id_col),
        "size",
        F.col("source").alias(source_col),
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(':', 'mix', CAST(doc_id AS VARCHAR))) AS key
  FROM documents),
src AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM sized GROUP BY source)),
filled AS (
  SELECT *, sum(n) OVER () - 3 * coalesce(sum(n) OVER before, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS ow
  FROM src WINDOW before AS (ORDER BY 3 * n / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT rest, ow FROM filled WHERE w * rest <= 3 * n * ow ORDER BY 3 * n / w, rank LIMIT 1),
targets AS (
  SELECT s.source, s.rank, s.n, CASE WHEN s.w * l.rest > 3 * s.n * l.ow THEN CAST(3 * s.n AS DOUBLE)
         ELSE CAST(s.w * l.rest AS DOUBLE) / CAST(l.ow AS DOUBLE) END AS target
  FROM src s CROSS JOIN level l),
queued AS (
  SELECT d.*, t.n, t.rank, t.target,
         CAST(sum(size) OVER (PARTITION BY t.rank ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, CAST(r * n + upto AS DOUBLE) / target AS finish FROM queued CROSS JOIN (SELECT unnest([0, 1, 2]) AS r)
  WHERE size > 0 AND r * n + upto - size < target),
ordered AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, r, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS words FROM copies),
taken AS (
  SELECT doc_id, sum(size) AS taken FROM ordered WHERE words <= (SELECT sum(size) FROM sized) GROUP BY doc_id)
SELECT q.doc_id, q.size, q.n AS source_size, q.target, CAST(coalesce(t.taken, 0) AS BIGINT) AS taken
FROM queued q LEFT JOIN taken t USING (doc_id)
"""
