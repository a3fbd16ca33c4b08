"""A training corpus in five stages: toxicity, near-duplicates, repeated substrings, contamination, mixture.

``STAGES`` lists (name, function) in the order of application. Every function takes (spark, docs, sf_dir) and returns a
frame; ``run`` writes each result as Parquet to the shared folder and reads it again as the next stage's documents. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, mixing, simhash, substrings, toxicity
from tidemark.llm.common import prepared, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# No stage of learning can be said in SQL; what tests/llm compares of the stages is in the README.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Learned from the labels outside the held-out quarter."""
    labels = _table(spark, sf_dir, "labels").filter(
        F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2
    )
    scored = toxicity.score(docs, labels.select("doc_id", "toxic"), keep=COLUMNS[1:])
    return scored.filter("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return simhash.first_of_each(docs).select(*COLUMNS)


def drop_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Characters inside 50-byte strings that an earlier document holds go; every document stays."""
    cut = substrings.deduplicate(docs, keep=("lang", "source"), characters=True)
    kept = cut.withColumn("text", F.col("kept").cast("string"))
    return kept.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least one word in twenty stands in a window of a benchmark item go."""
    found = decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"), keep=COLUMNS[1:])
    return found.filter("NOT contaminated").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: each document that is taken, with its words, its source's target and the words taken of it."""
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", drop_repeated_substrings),
    ("contamination", drop_contaminated),
    ("mixture", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages applied to ``documents``."""
    docs = _table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
