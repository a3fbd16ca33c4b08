"""Language identification by cross-parsing entropy."""

from __future__ import annotations

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import each_batch, prepared

# Labelled text behind each language's automaton: at most so many documents and, of these, so many bytes.
TRAIN_DOCS = 40
TRAIN_BYTES = 32 << 10
# Texts are parsed in pieces of this many bytes; a phrase ends with its piece.
PIECE = 512
# Pieces that are parsed side by side.
LANES = 4096

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def letters_of(text: str) -> bytes:
    """Lower-case words of letters, a blank between them: what the parse reads."""
    return _OTHER.sub(" ", text.lower()).encode()


def suffix_automaton(text: bytes, symbols: np.ndarray) -> np.ndarray:
    """Transitions of the suffix automaton as a table states x symbols; -1 where no suffix goes on.

    ``symbols`` numbers the 256 byte values.
    """
    width = int(symbols.max()) + 1
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols[np.frombuffer(text, dtype=np.uint8)].tolist():
        now = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = now
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    table = np.full((len(moves), width), -1, dtype=np.int32)
    for state, out in enumerate(moves):
        if out:
            table[state, list(out)] = list(out.values())
    return table


class Automata:
    """One automaton per language over one numbering of byte values; number 0 stands for every byte never learned."""

    def __init__(self, texts: dict[str, bytes]):
        self.langs = sorted(texts)
        seen = sorted(set(b"".join(texts.values())))
        self.symbols = np.zeros(256, dtype=np.int32)
        self.symbols[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        tables = [suffix_automaton(texts[k], self._padded()) for k in self.langs]
        starts = np.cumsum([0, *(len(t) for t in tables[:-1])])
        # One table for all: states of a language are shifted by those before it. The last state leads nowhere; a phrase that
        # no suffix matches is there.
        nowhere = np.full((1, self.width), -1, dtype=np.int32)
        shifted = [np.where(t >= 0, t + s, -1) for t, s in zip(tables, starts)]
        self.moves = np.concatenate([*shifted, nowhere]).astype(np.int32)
        self.roots = starts.astype(np.int32)

    def _padded(self) -> np.ndarray:
        return np.append(self.symbols, self.width - 1)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text in each language: texts x languages.

        A phrase is the longest match with the language's text from where the last one ended; a byte that starts none is
        a phrase by itself. All pieces of equal length move on together, in all languages.
        """
        owner, pieces = [], []
        for i, t in enumerate(texts):
            for a in range(0, len(t), PIECE):
                owner.append(i)
                pieces.append(t[a : a + PIECE])
        out = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
        for at in range(0, len(order), LANES):
            some = order[at : at + LANES]
            sizes = np.array([len(pieces[k]) for k in some])
            text = np.zeros((len(some), int(sizes.max())), dtype=np.uint8)
            for row, k in enumerate(some):
                text[row, : sizes[row]] = np.frombuffer(pieces[k], dtype=np.uint8)
            counts = self._parse(self.symbols[text.T], sizes)
            np.add.at(out, np.array([owner[k] for k in some]), counts)
        return out

    def _parse(self, steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """``steps``: symbols by place and lane, lanes from the longest down."""
        flat, width, k = self.moves.reshape(-1), self.width, len(self.roots)
        nowhere = len(self.moves) - 1
        state = np.full((k, len(sizes)), nowhere, dtype=np.int32)
        count = np.zeros((k, len(sizes)), dtype=np.int32)
        # first[lang, symbol]: the state after a phrase of that symbol alone.
        first = self.moves[self.roots]
        first = np.where(first >= 0, first, nowhere).astype(np.int32)
        active = len(sizes)
        for t in range(len(steps)):
            while sizes[active - 1] <= t:
                active -= 1
            c = steps[t, :active]
            new = flat[state[:, :active] * width + c]
            ended = new < 0
            count[:, :active] += ended
            state[:, :active] = np.where(ended, first[:, c], new)
        return count.T


def sample_of(texts: list[bytes], size: int) -> bytes:
    """At most ``size`` bytes with an equal share of every text: short texts whole, of a longer one pieces from all over it.

    The pieces of a text, and their order, are picked by their hashes; what short texts leave goes to the longer ones.
    """
    out, left = [], size
    for i, text in enumerate(sorted(texts, key=lambda t: (len(t), t))):
        share = max(0, left // (len(texts) - i) - 1)
        if len(text) > share:
            pieces = [text[a : a + PIECE] for a in range(0, len(text), PIECE)]
            length = min(PIECE, max(1, share))
            ranked = sorted(range(len(pieces)), key=lambda k: (xxhash.xxh64_intdigest(pieces[k], k), k))
            some, held = [], 0
            for k in ranked:
                if held >= share:
                    break
                some.append(pieces[k][: min(length, share - held)])
                held += len(some[-1]) + 1
            text = b" ".join(some)[:share]
        out.append(text)
        left -= len(text) + 1
    return b" ".join(out)


def training_texts(docs: DataFrame, text_col: str, lang_col: str) -> dict[str, bytes]:
    """A bounded sample of labelled text per language: the distinct texts with the smallest hashes, an equal share of each.

    Copies are dropped by hash before anything is ranked, one row for each in a task. Spark ranks within each task before the
    texts are shuffled, so a hot language ships ``TRAIN_DOCS`` texts per task.
    """
    order = Window.partitionBy("lang").orderBy("at")
    known = (
        docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .withColumn("at", F.xxhash64("text"))
    )
    least = (
        known.select("lang", "at").distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TRAIN_DOCS)
    )
    # The chosen hashes, TRAIN_DOCS numbers per language, travel to the texts.
    some = known.join(F.broadcast(least.select("lang", "at")), ["lang", "at"]).groupBy("lang", "at").agg(F.min("text").alias("text"))
    parts: dict[str, list[bytes]] = {}
    for r in some.select("lang", "text").collect():
        parts.setdefault(r["lang"], []).append(letters_of(r["text"]))
    out = {k: sample_of(v, TRAIN_BYTES) for k, v in parts.items()}
    return {k: v for k, v in out.items() if v.strip()}


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``id, lang_pred, score, phrases`` and the columns of ``keep``.

    The language whose text parses the document in the fewest phrases per byte wins; of equals the first by name.
    ``score`` is 1 minus the winner's share of the phrases of the next best (0 if they are equal, 1 if only one language
    was learned). ``labelled`` gives text and language; nothing else of it is used.

    Null text or no letter: ``und``, score 0. No labelled text at all: ``und`` everywhere. Texts are parsed whole, in
    pieces. Null id: as it is. Empty input: no rows.
    """
    spark = prepared(docs.sparkSession)
    texts = training_texts(labelled, text_col, lang_col)
    shared = spark.sparkContext.broadcast(Automata(texts) if texts else None)

    def work(batch) -> dict:
        automata = shared.value
        given = [t or "" for t in batch.column(text_col).to_pylist()]
        rows = [i for i, t in enumerate(given) if automata and _LETTER.search(t)]
        pred, score = ["und"] * len(given), [0.0] * len(given)
        if rows:
            counts = automata.phrases([letters_of(given[i]) for i in rows])
            best = counts.argmin(axis=1)
            ranked = np.sort(counts, axis=1)
            for i, b, r in zip(rows, best.tolist(), ranked.tolist()):
                pred[i] = automata.langs[b]
                score[i] = 1.0 - r[0] / r[1] if len(r) > 1 else 1.0
        return {c: batch.column(c) for c in (id_col, *keep)} | {"lang_pred": pred, "score": score}

    fields = [docs.schema[c] for c in (id_col, *keep)]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return each_batch(docs.select(*dict.fromkeys([id_col, text_col, *keep])), work, schema)
