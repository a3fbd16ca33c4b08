"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import each_batch, prepared, texts_of

WINDOW_WORDS = 13
# A document is contaminated if at least one in RATIO of its words is hit.
RATIO = 20
# Text of the items in one automaton; more items take further automata, one scan of the documents each.
BLOCK_BYTES = 8 << 20

# A-Z become lower case; every other ASCII character that is neither a digit nor a letter separates words. Bytes from
# 0x80 on belong to words, so the table works on UTF-8.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def windows_of(text: bytes, size: int = WINDOW_WORDS) -> set[bytes]:
    """The windows of an item, each between blanks: ``size`` words in a row, or all words of a shorter item."""
    words = words_of(text)
    if not words:
        return set()
    return {b" %b " % b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def automaton(items: list[tuple[str, bytes]], size: int = WINDOW_WORDS) -> bytes:
    """The automaton of (item id, text) pairs, pickled. A window knows all items that hold it."""
    import ahocorasick

    holders: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in windows_of(text, size):
            holders.setdefault(window, set()).add(item)
    found = ahocorasick.Automaton()
    for window, ids in holders.items():
        # latin-1 gives one character per byte, so places in the automaton's text are bytes.
        found.add_word(window.decode("latin-1"), (len(window), tuple(sorted(ids))))
    found.make_automaton()
    return pickle.dumps(found)


def occurrences(found, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words; first and last word of each occurrence; the items that occur."""
    words = words_of(text)
    line = b" %b " % b" ".join(words)
    spans, items = [], set()
    if len(found):
        for end, (length, ids) in found.iter(line.decode("latin-1")):
            spans.append((end - length + 1, end))
            items.update(ids)
    if spans:
        blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
        spans = [(int(np.searchsorted(blanks, a)), int(np.searchsorted(blanks, z)) - 1) for a, z in spans]
    return len(words), spans, items


def word_offsets(text: bytes) -> list[tuple[int, int]]:
    """Where each word of the normalised text stands in the original, in bytes: [start, end)."""
    solid = np.frombuffer(text.translate(NORMAL), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], solid.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of bounded size; only one block is on the driver at a time."""
    block, held = [], 0
    for item, text in benchmark.select(F.col(item_col).cast("string"), text_col).toLocalIterator():
        block.append(("" if item is None else item, (text or "").encode()))
        held += len(block[-1][1])
        if held >= BLOCK_BYTES:
            yield block
            block, held = [], 0
    yield block


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``id, n_words, n_hit, spans, items, contaminated`` and the columns of ``keep``.

    A document word is hit inside an occurrence of a window of any item. ``spans`` are the hit stretches in bytes of the
    original text, end exclusive; ``items`` the ids, as sorted strings, of the items with occurring windows.
    ``contaminated``: some word is hit and the hit words are at least 1 in 20.

    Null or empty text, of documents or items: no words, hence no hits. An item without id counts under the empty
    string. Items that share a window are all named; repeated items count once. No items: nothing is contaminated.
    The items are read in blocks of ``BLOCK_BYTES``, each one automaton and one broadcast; documents are scanned once
    per block, and the hits of several blocks meet in a scan of their own, never in a shuffle of texts.
    """
    spark = prepared(docs.sparkSession)
    shared = [spark.sparkContext.broadcast(automaton(b)) for b in _blocks(benchmark, item_col, item_text_col)]
    # The automata of a worker, one at a time: no more than one block is in memory beside the packed ones.
    loaded: dict[int, object] = {}

    def scan(batch) -> dict:
        texts = texts_of(batch, text_col)
        n = [0] * len(texts)
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        for k, packed in enumerate(shared):
            if k not in loaded:
                loaded.clear()
                loaded[k] = pickle.loads(packed.value)
            for i, text in enumerate(texts):
                n[i], more, ids = occurrences(loaded[k], text)
                spans[i] += more
                items[i] |= ids
        hits = [merged(s) for s in spans]
        places = [word_offsets(t) if h else [] for t, h in zip(texts, hits)]
        n_hit = [sum(z - a + 1 for a, z in h) for h in hits]
        return {c: batch.column(c) for c in (id_col, *keep)} | {
            "n_words": n,
            "n_hit": n_hit,
            "spans": [[{"start": p[a][0], "end": p[z][1]} for a, z in h] for h, p in zip(hits, places)],
            "items": [sorted(x) for x in items],
            "contaminated": [h > 0 and RATIO * h >= w for h, w in zip(n_hit, n)],
        }

    from pyspark.sql import types as T

    fields = [docs.schema[c] for c in (id_col, *keep)]
    found = T.StructType.fromDDL(
        "n_words bigint, n_hit bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>, "
        "contaminated boolean"
    )
    columns = list(dict.fromkeys([id_col, text_col, *keep]))
    return each_batch(docs.select(*columns), scan, T.StructType([*fields, *found.fields]))


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS words FROM benchmark),
w AS (
  SELECT DISTINCT item, least(len(words), 13) AS n, array_to_string(words[i:i + least(len(words), 13) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
hits AS (
  SELECT doc_id, i, n, item FROM (
    SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d
          CROSS JOIN (SELECT DISTINCT n FROM w) WHERE len(words) >= n)) JOIN w USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
