"""Documents for tests: awkward ones, and small corpora with known copies."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["id", "size", "key", "row", "doc", "_id", "print", "node", "score", "spans", "host", "label", "toxic", "_0", "kept"]


def docs_frame(spark, rows, clashing=False):
    df = spark.createDataFrame([(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in rows], SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHING})
    return df


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, odd characters."""
    rng = random.Random(3)
    long = prose(rng, 30_000)
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, None),
        (4, long, "de", "b"),
        (5, long, "de", "b"),
        (6, "é" * 3000, "fr", None),
        (7, "w1 w2 w3", "en", "a"),
        (7, "w1 w2 w3", "en", "a"),
        (7, prose(rng, 80), "en", "a"),
        (None, long[:4000], "en", "a"),
        (None, None, None, None),
        (8, "ab " * 5000, "en", "c"),
        (9, "x" * 40_000, "en", "c"),
        (10, "日本語 テキスト 漢字 " * 40, "ja", "c"),
        (11, "\u0000\u001c a b   <|endoftext|> \U0001f600", "en", "c"),
    ]
    return rows + [(20 + i, prose(rng, 60 + i), "en", f"s{i % 3}") for i in range(12)]


def prepared_session(spark):
    from tidemark.llm.common import prepared

    return prepared(spark)


def need(module):
    return pytest.importorskip(module)
