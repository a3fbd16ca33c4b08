"""Near-duplicates by SimHash: fingerprints that differ in two bits or fewer are linked."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LARGEST, comparable_id, each_batch, prepared, texts_of
from tidemark.session import checkpointed

BITS, SEGMENTS, MAX_DISTANCE = 64, 2, 2
# Fingerprints of a table entry that are compared pair by pair; more of them meet at points between them.
CROWDED = 64
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """SimHash over shingles of ``size`` words, repeats included; 0 for a text without words."""
    import xxhash

    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - size + 1)
    last = ends[size - 1 :] if len(words) >= size else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:z], seed) for a, z in zip(starts[:n].tolist(), last.tolist())], dtype=np.uint64
    )
    ones = np.zeros(BITS, dtype=np.int64)
    for part in np.array_split(hashes, n // 65536 + 1):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str) -> DataFrame:
    """The other columns and the text's fingerprint as a signed 64-bit number."""
    kept = [f for f in docs.schema.fields if f.name != text_col]

    def work(batch) -> dict:
        prints = np.array([fingerprint(t) for t in texts_of(batch, text_col)], dtype=np.uint64)
        return {f.name: batch.column(f.name) for f in kept} | {"print": prints.view(np.int64)}

    return each_batch(docs, work, T.StructType([*kept, T.StructField("print", T.LongType())]))


def segments(print_: Column, flips: bool) -> Column:
    """``segment, value`` of a fingerprint's table entries, or of its look-ups: all values one flipped bit around."""
    width = BITS // SEGMENTS
    out = []
    for s in range(SEGMENTS):
        value = F.shiftrightunsigned(print_, s * width).bitwiseAND(F.lit((1 << width) - 1))
        for flip in [0, *(1 << b for b in range(width))] if flips else [0]:
            out.append(F.struct(F.lit(s).alias("segment"), value.bitwiseXOR(F.lit(flip).cast("bigint")).alias("value")))
    return F.array(*out)


def looked_up(prints: DataFrame, crowded: int) -> tuple[DataFrame, DataFrame]:
    """Multi-index hashing: candidate pairs ``a, b`` from a table per segment, and the fingerprints that are left over.

    Of two bits that differ one segment of two holds at most one, so one fingerprint lies in the ball of radius one
    around the other's value there. Every fingerprint is entered in each table under its own value and looks up its ball.
    A table entry with more than ``crowded`` fingerprints is not paired; who stands in it or looks it up is left over.
    """
    entries = prints.select("print", F.explode(segments(F.col("print"), False)).alias("e")).select("print", "e.*")
    sizes = entries.groupBy("segment", "value").agg(F.count(F.lit(1)).alias("n"))
    lookups = prints.select("print", F.explode(segments(F.col("print"), True)).alias("e")).select("print", "e.*")
    table = entries.join(sizes.filter(F.col("n") <= crowded).select("segment", "value"), ["segment", "value"])
    fetched = lookups.toDF("a", "segment", "value").join(table.toDF("segment", "value", "b"), ["segment", "value"])
    full = sizes.filter(F.col("n") > crowded).select("segment", "value")
    return fetched.filter("a > b").select("a", "b"), lookups.join(full, ["segment", "value"]).select("print").distinct()


def meeting_points(prints: DataFrame) -> DataFrame:
    """Links within crowded table entries: each member of a group to the smallest, whoever else is in it.

    A key is a ball member of one segment next to the other segment unchanged. Two fingerprints one bit apart meet at
    each other, two bits apart at one between them; those that meet are two bits apart at most. At most 65 can meet at a
    key, all within reach of each other, so none of their pairs is needed but those with the smallest.
    """
    flips = [0, *(1 << b for b in range(BITS - 1)), -(1 << (BITS - 1))]
    around = F.explode(F.array(*[F.lit(x).cast("bigint") for x in flips])).alias("flip")
    met = prints.select("print", around).select(F.col("print").bitwiseXOR(F.col("flip")).alias("key"), "print")
    order = Window.partitionBy("key").orderBy("print").rowsBetween(Window.unboundedPreceding, 0)
    return met.select(F.col("print").alias("a"), F.first("print").over(order).alias("b")).filter("a > b")


def links(prints: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links ``a, b`` between the fingerprints of the frame, one row each in ``print``, two bits apart or less.

    Every link between two fingerprints is there, or both are linked to a third one that is linked to either.
    """
    pairs, rest = looked_up(prints, crowded)
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    met = meeting_points(checkpointed(rest))
    return pairs.unionByName(met).filter(apart <= MAX_DISTANCE).distinct()


def _star(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Tie the neighbours of every node to the smallest of them (or the node itself, if smaller).

    Neighbours of a node: all of them (and only larger ones are tied anew), or the smaller ones only.
    """
    if both_ways:
        arcs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        arcs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = arcs.join(least, "u")
    if both_ways:
        new = tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        new = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return new.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of an edge: the smallest node it can reach.

    Alternating large and small stars until the edges no longer change. Each round is written to the shared folder and
    cuts the lineage. A node with many neighbours costs its partial minimum and a join that Spark can split.
    """

    def state(frame: DataFrame):
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = checkpointed(edges)
    before, now = None, state(edges)
    while now[0] and now != before:
        edges = checkpointed(_star(_star(edges, True), False))
        before, now = now, state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, crowded: int) -> DataFrame:
    """``id, at, print, id_, least``: per document row a hash of its text, its fingerprint, its id as a number that is never
    null, and the least such number of the component.
    """
    texts = docs.select(id_col, text_col).withColumn("_at", F.xxhash64(text_col))
    prints = checkpointed(fingerprints(texts, text_col).withColumn("_id", comparable_id(id_col)))
    nodes = checkpointed(prints.groupBy("print").agg(F.min("_id").alias("_least")))
    found = components(links(nodes.select("print"), crowded))
    known = nodes.join(found.withColumnRenamed("node", "print"), "print", "left")
    known = known.withColumn("component", F.coalesce("component", "print"))
    least = known.groupBy("component").agg(F.min("_least").alias("_least"))
    return prints.join(known.select("print", "component").join(least, "component"), "print")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowded: int = CROWDED
) -> DataFrame:
    """One row per document: ``id, print`` (signed), ``component_id``, the smallest id its fingerprint reaches.

    Copies of a fingerprint become one node before anything is linked. Null or empty text: fingerprint 0, linked like
    any other. Null id: larger than every other; a group of null ids alone has a null component. Repeated rows: one row
    each. Empty input: no rows.
    """
    prepared(docs.sparkSession)
    least = F.when(F.col("_least") != LARGEST, F.col("_least"))
    return _grouped(docs, id_col, text_col, crowded).select(id_col, "print", least.alias("component_id"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document (all columns) of each group: that with the smallest id, null ids last.

    Of several rows of that id the one whose text has the smallest hash stays, and of rows that are alike in both the
    smallest in the order of all columns. Only ids and hashes travel to the decision; texts are read again.
    """
    prepared(docs.sparkSession)
    groups = _grouped(docs, id_col, text_col, CROWDED)
    first = groups.groupBy("component").agg(F.min(F.struct("_id", "_at")).alias("k"))
    rows = groups.groupBy("_id", "_at").agg(F.count(F.lit(1)).alias("_rows"))
    keep = checkpointed(first.select("k.*").join(rows, ["_id", "_at"]))
    own = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)])
    keyed = docs.select(comparable_id(id_col).alias("_id"), F.xxhash64(text_col).alias("_at"), own.alias("row"))
    kept = keyed.join(keep, ["_id", "_at"])
    alone = kept.filter("_rows = 1").select("row")
    # Rows that are alike in id and text are reduced where they are read, however many there are.
    alike = kept.filter("_rows > 1").groupBy("_id", "_at").agg(F.min("row").alias("row")).select("row")
    both = alone.unionByName(alike)
    return both.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
