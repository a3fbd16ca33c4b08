"""Token counts by a two-tier table of pre-token lengths."""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import each_batch, prepared, texts_of

# The broadcast table: at most so many pre-tokens, none longer than LONGEST bytes (some 3 MB).
FREQUENT = 1 << 15
LONGEST = 64
# It is fitted on so many documents, whatever the input; it decides how fast a length is found, never the length.
SAMPLE_DOCS = 4000
# Pre-tokens a worker remembers, none longer than LONGEST bytes, before it starts over (some 40 MB).
REMEMBERED = 1 << 18


def check_separable(path: str) -> None:
    """Only vocabularies that drop white space may be counted piece by piece; refuse any other."""
    with open(path, encoding="utf-8") as f:
        kind = json.load(f)
    steps = kind["pre_tokenizer"].get("pretokenizers", [kind["pre_tokenizer"]])
    first = steps[0]
    drops = first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
    if not drops or r"[^\s" not in first["pattern"]["Regex"] or kind["post_processor"] or kind["truncation"]:
        raise ValueError(f"{path}: tokens may reach over white space; pieces cannot be counted one by one")


class Lengths(dict):
    """Length in tokens of a piece of text between white space. Unknown pieces go to the tokenizer, short ones stay."""

    def __init__(self, path: str, frequent: dict[bytes, int]):
        from tokenizers import Tokenizer

        super().__init__(frequent)
        self.encode = Tokenizer.from_file(path).encode
        self.frequent = frequent

    def __missing__(self, piece: bytes) -> int:
        n = len(self.encode(piece.decode(), add_special_tokens=False))
        if len(piece) <= LONGEST:
            if len(self) >= len(self.frequent) + REMEMBERED:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def frequent_lengths(docs: DataFrame, text_col: str, path: str) -> dict[bytes, int]:
    """Lengths of the most frequent pieces of ``SAMPLE_DOCS`` documents spread over all of them."""
    n = docs.count()
    some = docs.sample(fraction=min(1.0, SAMPLE_DOCS / max(n, 1)), seed=7).select(text_col)

    def count(batch) -> dict:
        pieces = Counter(p for t in texts_of(batch, text_col) for p in t.split() if len(p) <= LONGEST)
        return {"piece": list(pieces), "n": list(pieces.values())}

    counted = each_batch(some, count, "piece binary, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "piece").limit(FREQUENT).collect()
    lengths = Lengths(path, {})
    return {bytes(r["piece"]): lengths[bytes(r["piece"])] for r in top}


def token_counts(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens).

    Counts are those of the tokenizer file at ``path`` without begin, end or added tokens; its special strings inside
    a text count as its library has them. No token reaches over ASCII white space, so a text's count is the sum over its
    pieces: first a broadcast table of frequent pieces, then what the worker has met, then the tokenizer itself.
    No piece is shuffled but those of the bounded sample behind the table.

    Null or empty text: 0 bytes, 0 tokens. Null id: returned as it is. Pieces of any length are encoded whole and, when
    long, not remembered. Empty input: no rows.
    """
    spark = prepared(docs.sparkSession)
    check_separable(path)
    table = spark.sparkContext.broadcast(frequent_lengths(docs, text_col, path))
    worker: list[Lengths] = []

    def count(batch) -> dict:
        if not worker:
            worker.append(Lengths(path, table.value))
        known = worker[0].__getitem__
        texts = texts_of(batch, text_col)
        n = [sum(map(known, t.split())) for t in texts]
        return {
            id_col: batch.column(id_col),
            "n_bytes": [len(t) for t in texts],
            "n_tokens": n,
            "over_limit": [x > limit for x in n],
        }

    from pyspark.sql import types as T

    schema = T.StructType(
        [docs.schema[id_col], *T.StructType.fromDDL("n_bytes bigint, n_tokens bigint, over_limit boolean").fields]
    )
    return each_batch(docs.select(id_col, text_col), count, schema)
