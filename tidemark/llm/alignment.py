"""Cross-tokenizer alignment: which tokens of two tokenizers stand on the same bytes, and how often over a corpus.

Neither tokenizer has a token that reaches from a character that is no white space into the blank after it, so a text
falls into chunks, each a blank and what follows, that are encoded and aligned by themselves. A worker remembers the
chunks that it has met; new ones are aligned together by interval coalescing:

1. The tokens of A and B of all new chunks are intervals of bytes. They are sorted by start; where a start reaches
   the running maximum of the ends, a group begins. Inside a group every overlap of a token of A with one of B is a link.
2. A text is the sequence of its chunks: sums of their figures, their groups one after the other, their pairs of ids with
   multiplicities. The distinct pairs of every text are stored.
3. Pairs are counted over texts, and every pair is marked if no other of its A id has a higher count.
4. The counts return to the texts through two tiers: a broadcast table of the most frequent pairs, of bounded size; pairs
   outside of it are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import each_batch, prepared, stored, texts_of

# The broadcast table: at most so many pairs, 17 bytes each. It decides how a count is found, never the count.
FREQUENT = 1 << 18
# Chunks a worker remembers, and their bytes, before it starts over.
REMEMBERED, REMEMBERED_BYTES = 250_000, 16 << 20
# Text that is aligned at a time; a longer text is aligned whole.
PIECE_BYTES = 2 << 20
BLANK = "▁"
DOUBTFUL = re.compile(r"\s(?: |\Z)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary, reversed: printable bytes stand for
    themselves, the others for the code points from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class TokenizerA:
    """A byte-level vocabulary file of the tokenizers library; special strings inside a text are plain text.

    Where its merges stand in the order of its ids, as they do in the published vocabularies, the same ids come several
    times faster from tiktoken, given the vocabulary of this file; otherwise from the library itself.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        step = kind["pre_tokenizer"]
        if step["type"] != "ByteLevel" or step["add_prefix_space"] or not step["use_regex"] or kind["normalizer"]:
            raise ValueError(f"{path}: not a byte-level vocabulary; chunks cannot be encoded one by one")
        letters = byte_letters()
        vocabulary, merges = kind["model"]["vocab"], kind["model"]["merges"]
        special = {t["content"]: t["id"] for t in kind["added_tokens"]}
        plain = {t: i for t, i in vocabulary.items() if t not in special}
        self.bytes = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for token, i in plain.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            self.bytes[i] = token.encode()
        made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
        ordered = made == sorted(made) and len(plain) == len(made) + 256 and not kind["model"].get("ignore_merges")
        self.encode = self._by_ranks(plain) if ordered else self._by_library(path)

    def _by_ranks(self, plain: dict[str, int]):
        import public_tokenizers
        import tiktoken

        ranks = {self.bytes[i]: i for i in plain.values()}
        one = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda chunks: list(map(one, chunks))

    @staticmethod
    def _by_library(path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda chunks: [e.ids for e in tokenizer.encode_batch(chunks, add_special_tokens=False)]


class TokenizerB:
    """A sentencepiece model that puts a blank before a text and has no piece with a blank after another character."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError(f"{path}: pieces reach over blanks; chunks cannot be encoded one by one")
        self.blank = self.model.piece_to_id(BLANK)
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        """The blank that every chunk begins with is the one the model adds; it adds none to an empty text."""
        found = self.model.encode([c[1:] for c in chunks], num_threads=1)
        return [ids if len(c) > 1 else [self.blank] for c, ids in zip(chunks, found)]


def chunks_of(text: str) -> list[str]:
    """The chunks of a blank and ``text``, without the blank each begins with.

    A chunk ends before a blank that follows a character other than white space.
    """
    words = text.split(" ")
    if not DOUBTFUL.search(" " + text):
        return words
    out, held = [], []
    for w in words:
        held.append(w)
        if w and not w[-1].isspace():
            out.append(" ".join(held))
            held = []
    return [*out, " ".join(held)] if held else out


def coalesced(start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of intervals by start (kind decides ties), and the group of each in that order.

    A group breaks where a start reaches the running maximum of the ends before it.
    """
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.concatenate(([True], start[order][1:] >= reach[:-1])) if len(order) else np.zeros(0, dtype=bool)
    return order, np.cumsum(breaks) - 1


def expanded(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] of them, then those of first[1], and so on."""
    before = np.cumsum(count) - count
    return np.arange(count.sum()) - np.repeat(before - first, count)


class Chunks(dict):
    """Numbers of chunks in the order in which they are first asked for; ``new`` are those since it was emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        self.new.append(chunk)
        return n


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The length of each list, and all their numbers."""
    n = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return n, np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=n.sum())


class Aligner:
    """Alignments of chunks, remembered: figures by chunk and, one after the other, the pairs of each."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = TokenizerA(path_a), TokenizerB(path_b)
        self.size_a = np.array(list(map(len, self.a.bytes)), dtype=np.int64)
        self.size_b = np.array(list(map(len, self.b.bytes)), dtype=np.int64)
        # Decimal ids with what may follow: a comma within the tokens of a kind, a bar after those of A, a semicolon after those of B.
        n = max(len(self.a.bytes), len(self.b.bytes))
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(n)]
        self.names = n
        self.clear()

    def clear(self) -> None:
        self.known = Chunks()
        self.held = 0
        self.groups: list[str] = []
        # n_a, n_b, n_groups, n_links and 1 if the bytes are those of the chunk.
        self.figures = np.zeros((0, 5), dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.ends = np.zeros(1, dtype=np.int64)

    def same_bytes(self, raw: list[bytes], ids: list[list[int]], tokens: list[bytes], sizes: np.ndarray) -> list[bool]:
        """Whether the tokens of each chunk are its bytes: of all together, one by one only if that fails."""
        n, numbers = flat(ids)
        owner = np.repeat(np.arange(len(ids)), n)
        lengths = np.bincount(owner, weights=sizes[numbers], minlength=len(raw)).astype(np.int64)
        if (lengths == np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))).all():
            if b"".join(map(tokens.__getitem__, numbers.tolist())) == b"".join(raw):
                return [True] * len(raw)
        return [b"".join(map(tokens.__getitem__, x)) == t for x, t in zip(ids, raw)]

    def learn(self) -> None:
        """Align the chunks that were asked for and are not aligned yet."""
        new, self.known.new = self.known.new, []
        if not new:
            return
        chunks = [" " + w for w in new]
        raw = [c.encode() for c in chunks]
        ids_a, ids_b = self.a.encode(chunks), self.b.encode(chunks)
        right = np.array(self.same_bytes(raw, ids_a, self.a.bytes, self.size_a))
        right &= self.same_bytes(raw, ids_b, self.b.bytes, self.size_b)
        if not right.all():
            ids_a, ids_b = ([i if ok else [] for i, ok in zip(ids, right)] for ids in (ids_a, ids_b))
        (n_a, a), (n_b, b) = flat(ids_a), flat(ids_b)
        chunk = np.concatenate([np.repeat(np.arange(len(new)), n) for n in (n_a, n_b)])
        # All tokens of one kind stand one after the other, chunk after chunk, in both kinds on the same bytes.
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        start_a, start_b = end_a - self.size_a[a], end_b - self.size_b[b]
        kind = np.repeat([0, 1], [len(a), len(b)])
        order, group = coalesced(np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b]), kind)
        # Links: the tokens of B that end after a token of A starts and start before it ends.
        low, high = np.searchsorted(end_b, start_a, side="right"), np.searchsorted(start_b, end_a, side="left")
        linked = high - low
        pairs = np.repeat(a, linked) * len(self.b.bytes) + b[expanded(low, linked)]
        # Written groups: within each the tokens of A, then those of B.
        by_group = np.argsort(2 * group + kind[order], kind="stable")
        order, group = order[by_group], group[by_group]
        k, ids = kind[order], np.concatenate([a, b])[order]
        last = np.concatenate([(k[1:] != k[:-1]) | (group[1:] != group[:-1]), [True]]) if len(k) else np.zeros(0, bool)
        mark = np.where(last, 1 + k, 0)
        text = list(map(self.written.__getitem__, (mark * self.names + ids).tolist()))
        at = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        closes = np.bincount(chunk[order], weights=mark == 2, minlength=len(new)).astype(np.int64)
        links = np.bincount(chunk[: len(a)], weights=linked, minlength=len(new)).astype(np.int64)
        self.groups += ["".join(text[i:z]) for i, z in zip(at, at[1:])]
        self.figures = np.concatenate([self.figures, np.stack([n_a, n_b, closes, links, right], axis=1)])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(links)])
        self.held += sum(map(len, raw))

    def texts(self, texts: list[bytes]) -> dict:
        """Figures, groups and distinct pairs of texts."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.clear()
        words = [chunks_of(t.decode()) if t else [] for t in texts]
        count = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=count.sum())
        self.learn()
        owner = np.repeat(np.arange(len(texts)), count)
        wrong = np.bincount(owner[self.figures[at, 4] == 0], minlength=len(texts)) > 0
        numbers, edge = at.tolist(), np.concatenate([[0], np.cumsum(count)]).tolist()
        written = self.groups.__getitem__
        digests = [
            "" if bad or i == z else hashlib.sha256("".join(map(written, numbers[i:z]))[:-1].encode()).hexdigest()
            for i, z, bad in zip(edge, edge[1:], wrong.tolist())
        ]
        if wrong.any():
            kept = ~wrong[owner]
            at, owner = at[kept], owner[kept]
        sums = [
            np.bincount(owner, weights=self.figures[at, c], minlength=len(texts)).astype(np.int64) for c in range(4)
        ]
        # Chunks of a text once, with their number; then their pairs, those of a text summed.
        many = max(len(self.groups), 1)
        cell, times = np.unique(owner * many + at, return_counts=True)
        owner, at = cell // many, cell % many
        size = self.ends[at + 1] - self.ends[at]
        pair = self.pairs[expanded(self.ends[at], size)]
        owner, times = np.repeat(owner, size), np.repeat(times, size)
        span = len(self.a.bytes) * len(self.b.bytes)
        order = np.argsort(owner * span + pair)
        owner, pair, times = owner[order], pair[order], times[order]
        first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1]))))
        if not len(pair):
            first = first[:0]
        times = np.add.reduceat(times, first) if len(first) else times
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(texts)))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (pair[first], times.astype(np.int32))]
        names = ("n_a", "n_b", "n_groups", "n_links")
        return dict(zip(names, map(pa.array, sums))) | {"groups_sha256": digests, "pairs": lists[0], "times": lists[1]}


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of each text; a pair is a * |B| + b."""
    worker: list[Aligner] = []

    def work(batch) -> dict:
        if not worker:
            worker.append(Aligner(path_a, path_b))
        texts = texts_of(batch, text_col)
        cut = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))) // PIECE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(texts)]
        parts = [worker[0].texts(texts[i:z]) for i, z in zip(edges, edges[1:])]
        columns = {c: [x for p in parts for x in p[c]] if c == "groups_sha256" else pa.concat_arrays([p[c] for p in parts]) for c in parts[0]}
        return {id_col: batch.column(id_col)} | columns

    fields = (
        "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
    )
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL(fields).fields])
    return each_batch(docs.select(id_col, text_col), work, schema)


def pair_counts(texts: DataFrame, n_b: int) -> DataFrame:
    """``a, b, n, best``: the number of texts that hold each pair, and whether no other of ``a`` has more."""
    counted = texts.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    split = counted.select(F.expr(f"pair div {n_b}").alias("a"), (F.col("pair") % n_b).alias("b"), "pair", "n")
    most = split.groupBy("a").agg(F.max("n").alias("most"))
    return split.join(most, "a").select("a", "b", "pair", "n", (F.col("n") == F.col("most")).alias("best"))


def with_counts(texts: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """Add ``n_best`` and ``count_sum`` to ``texts``, which has a unique ``row``."""
    top = counts.orderBy(F.desc("n"), "pair").limit(frequent).select("pair", "n", "best").toArrow().sort_by("pair")
    table = texts.sparkSession.sparkContext.broadcast([top.column(c).to_numpy() for c in ("pair", "n", "best")])
    kept = [f for f in texts.schema.fields if f.name not in ("pairs", "times")]
    fields = "_best bigint, _sum bigint, _rest array<struct<pair: bigint, times: int>>"
    schema = T.StructType([*kept, *T.StructType.fromDDL(fields).fields])

    def work(batch) -> dict:
        pair_of, n_of, best_of = table.value
        lists = batch.column("pairs")
        pair = lists.flatten().to_numpy(zero_copy_only=False)
        times = batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        at = np.minimum(np.searchsorted(pair_of, pair), max(len(pair_of) - 1, 0))
        found = pair_of[at] == pair if len(pair_of) else np.zeros(len(pair), dtype=bool)
        n, best = np.zeros(len(pair), dtype=np.int64), np.zeros(len(pair), dtype=np.int64)
        n[found], best[found] = n_of[at[found]], best_of[at[found]]
        # Sums of integers that may pass 2**53: no floating weights.
        sums = [np.zeros(len(lists), dtype=np.int64) for _ in range(2)]
        np.add.at(sums[0], owner, best * times)
        np.add.at(sums[1], owner, n * times)
        missed = np.flatnonzero(~found)
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owner[missed], minlength=len(lists)))]).astype(np.int32)
        rest = pa.StructArray.from_arrays(
            [pa.array(pair[missed]), pa.array(times[missed].astype(np.int32))], names=["pair", "times"]
        )
        columns = {f.name: batch.column(f.name) for f in kept}
        return columns | {"_best": sums[0], "_sum": sums[1], "_rest": pa.ListArray.from_arrays(offsets, rest)}

    scored = stored(each_batch(texts, work, schema), "aligned-scored")
    rest = (
        scored.select("row", F.explode("_rest").alias("r"))
        .select("row", "r.pair", "r.times")
        .join(counts.select("pair", "n", "best"), "pair")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("best").cast("bigint")).alias("_b"), F.sum(F.col("times") * F.col("n")).alias("_s"))
    )
    return (
        scored.drop("_rest")
        .join(rest, "row", "left")
        .withColumns(
            {
                "n_best": F.col("_best") + F.coalesce("_b", F.lit(0)),
                "count_sum": F.col("_sum") + F.coalesce("_s", F.lit(0)),
            }
        )
        .drop("_best", "_sum", "_b", "_s")
    )


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
) -> tuple[DataFrame, DataFrame]:
    """Alignment of a byte-level vocabulary (A) with a sentencepiece model (B), both over a blank and the text.

    Returns two frames. One row per document: ``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``;
    one row per linked pair of ids: ``a, b, n, best`` (documents that hold the pair linked; no other pair of ``a`` is held
    by more).

    Null or empty text, or one that either tokenizer does not give back byte for byte: zeros, '' and no part in any
    count. Ties of the highest count: all are best. Repeated rows and null ids: each row counts as a document. Chunks
    of any length are encoded whole. Empty input: no rows.
    """
    prepared(docs.sparkSession)
    n_b = len(TokenizerB(path_b).bytes)
    found = aligned(docs, path_a, path_b, id_col, text_col).withColumnRenamed(id_col, "_doc")
    texts = stored(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = stored(pair_counts(texts, n_b), "aligned-pairs")
    rows = with_counts(texts, counts, frequent).select(
        F.col("_doc").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
    return rows, counts.drop("pair")
