"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import each_batch, prepared, texts_of
from tidemark.llm.decontamination import NORMAL
from tidemark.session import checkpointed

# Labelled documents the model is fitted on, about so many whatever the input: a hash of the id picks them.
LABELLED = 40_000
# Signs: words, and beginnings of words of these many bytes, that speak for toxic text.
BEGINNINGS = (5, 6, 7, 8)
SIGNS = 8192
LEAST_DOCS, LEAST_Z = 3, 2.5
LEVELS = 7
# Tokens further than this from every sign are clean; the others form the stretches that the field tags.
REACH = 4
LONGEST = 128
# Documents with signs that the weights are fitted on, about so many and whole; hashes of the ids pick them. The field is
# fitted on about TRAIN_PARTS stretches for each, picked by hash from all over the texts of all documents with signs, up to
# TRAIN_STRETCHES distinct ones.
TRAIN_DOCS, TRAIN_PARTS, TRAIN_STRETCHES = 5000, 20, 2048
REMEMBERED = 1 << 18


def tokens_of(text: bytes) -> list[bytes]:
    return text.decode().lower().encode().translate(NORMAL).split()


def features_of(token: bytes) -> list[bytes]:
    """The word, and its beginnings (of bytes, marked so that they differ from words)."""
    return [token, *(b"^" + token[:k] for k in BEGINNINGS if len(token) > k)]


class Levels(dict):
    """Level of a token, 0 (no sign) to ``LEVELS``: that of its strongest feature."""

    def __init__(self, signs: dict[bytes, int]):
        super().__init__()
        self.signs = signs

    def __missing__(self, token: bytes) -> int:
        level = max(self.signs.get(f, 0) for f in features_of(token))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(token) < 64:
            self[token] = level
        return level


def stretches(levels: list[int]) -> list[tuple[int, int]]:
    """First and last token of each stretch around signs, none longer than ``LONGEST``."""
    out: list[list[int]] = []
    for at, level in enumerate(levels):
        if level:
            a, z = max(0, at - REACH), min(len(levels) - 1, at + REACH)
            if out and a <= out[-1][1] + 1:
                out[-1][1] = z
            else:
                out.append([a, z])
    return [(k, min(k + LONGEST - 1, z)) for a, z in out for k in range(a, z + 1, LONGEST)]


@dataclass
class Field:
    """Weights of the field with states clean and toxic: a level's weight for toxic, moves between states, start."""

    level: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def marginals(
        self, rows: list[np.ndarray], weights: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward-backward over stretches side by side: padded levels, mask, P(toxic) by place, expected moves."""
        n, width = len(rows), max(map(len, rows))
        x = np.zeros((n, width), dtype=np.int64)
        mask = np.zeros((n, width), dtype=bool)
        for i, r in enumerate(rows):
            x[i, : len(r)], mask[i, : len(r)] = r, True
        emit = np.zeros((n, width, 2))
        emit[:, :, 1] = self.level[x]
        emit[~mask] = 0.0
        ahead = np.zeros((n, width, 2))
        ahead[:, 0] = self.start + emit[:, 0]
        for t in range(1, width):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + self.moves, axis=1) + emit[:, t]
            ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
        back = np.zeros((n, width, 2))
        for t in range(width - 2, -1, -1):
            step = np.logaddexp.reduce(self.moves + (emit[:, t + 1] + back[:, t + 1])[:, None, :], axis=2)
            back[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        toxic = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None]) * mask
        pair = np.zeros((2, 2))
        if width > 1 and weights is not None:
            joint = (
                ahead[:, :-1, :, None] + self.moves + (emit[:, 1:] + back[:, 1:])[:, :, None, :] - total[:, None, None, None]
            )
            pair = (np.exp(joint) * (mask[:, 1:] * weights[:, None])[:, :, None, None]).sum(axis=(0, 1))
        return x, mask, toxic, pair

    def tagged(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        """P(toxic) of every token of every stretch."""
        out: list[np.ndarray] = [np.zeros(0)] * len(rows)
        order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
        for at in range(0, len(order), 512):
            some = order[at : at + 512]
            toxic = self.marginals([rows[i] for i in some])[2]
            for k, i in enumerate(some):
                out[i] = toxic[k, : len(rows[i])]
        return out


def fit_field(stretches_: dict[tuple[bytes, bool], int], rounds: int = 120, decay: float = 1.0) -> Field:
    """Maximum likelihood with a quadratic penalty. A token is labelled toxic if it is a sign in a toxic document.

    ``stretches_``: levels of a stretch and whether its document is toxic, with how often that occurs.
    """
    field = Field(np.zeros(LEVELS + 1), np.zeros((2, 2)), np.zeros(2))
    if not stretches_:
        field.level[:] = -4.0
        return field
    given = sorted(stretches_.items(), key=lambda s: (len(s[0][0]), s[0]))
    rows = [np.frombuffer(levels, dtype=np.uint8) for (levels, _), _ in given]
    weights = np.array([n for _, n in given], dtype=np.float64)
    size = sum(len(r) * w for r, w in zip(rows, weights))
    names = ("level", "moves", "start")
    first = {k: np.zeros_like(getattr(field, k)) for k in names}
    second = {k: np.zeros_like(getattr(field, k)) for k in names}
    seen, moves, start = np.zeros(LEVELS + 1), np.zeros((2, 2)), np.zeros(2)
    for r, w, ((_, toxic), _) in zip(rows, weights, given):
        y = ((r > 0) & toxic).astype(int)
        np.add.at(seen, r, y * w)
        np.add.at(moves, (y[:-1], y[1:]), w)
        start[y[0]] += w
    for k in range(1, rounds + 1):
        expected, pair, begin = np.zeros(LEVELS + 1), np.zeros((2, 2)), np.zeros(2)
        for at in range(0, len(rows), 512):
            w = weights[at : at + 512]
            x, mask, p, both = field.marginals(rows[at : at + 512], w)
            expected += np.bincount(x[mask], weights=(p * w[:, None])[mask], minlength=LEVELS + 1)
            pair += both
            begin += [(w * (1 - p[:, 0])).sum(), (w * p[:, 0]).sum()]
        ups = {"level": seen - expected, "moves": moves - pair, "start": start - begin}
        for name in names:
            value = getattr(field, name)
            slope = (ups[name] - decay * value) / size
            first[name] = 0.9 * first[name] + 0.1 * slope
            second[name] = 0.99 * second[name] + 0.01 * slope**2
            value += 0.1 * (first[name] / (1 - 0.9**k)) / (np.sqrt(second[name] / (1 - 0.99**k)) + 1e-9)
    # A level weighs no less than those below it, seen or not.
    field.level = np.maximum.accumulate(field.level)
    return field


@dataclass
class Model:
    signs: dict[bytes, int]
    field: Field
    # Score: logistic of these weights over the summaries of the marginals.
    weights: np.ndarray

    def tag(self, texts: list[bytes], levels: Levels) -> list[tuple[list[tuple[int, int]], np.ndarray]]:
        """Per text: its stretches and the P(toxic) of their tokens, one after the other."""
        found = [list(map(levels.__getitem__, tokens_of(t))) for t in texts]
        parts = [stretches(x) if any(x) else [] for x in found]
        p = self.field.tagged([np.array(x[a : z + 1]) for x, s in zip(found, parts) for a, z in s])
        out, used = [], 0
        for s in parts:
            out.append((s, np.concatenate([np.zeros(0), *p[used : used + len(s)]])))
            used += len(s)
        return out

    def scores(self, marginals: list[np.ndarray]) -> np.ndarray:
        z = summaries(marginals) @ self.weights
        return 1 / (1 + np.exp(-z))


def summaries(marginals: list[np.ndarray]) -> np.ndarray:
    """1, the surprise if no token were toxic (at most 10), the largest marginal."""
    rows = [[1.0, min(10.0, -np.log1p(-np.minimum(p, 0.9999)).sum()), p.max(initial=0.0)] for p in marginals]
    return np.array(rows).reshape(-1, 3)


def fit_scores(x: np.ndarray, y: np.ndarray, weights: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps with a slight quadratic penalty."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weights * (y - p)) - 0.1 * w
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return w


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``text, toxic, fold, pick`` of about ``LABELLED`` labelled documents. The labels travel to the texts, not the texts."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("toxic"))
    share = min(1.0, LABELLED / max(1, known.count()))
    some = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # About LABELLED rows of two numbers: below a megabyte whatever the input.
    own = docs.select(F.col(id_col).alias("_own"), F.coalesce(text_col, F.lit("")).alias("text"))
    return own.join(F.broadcast(some), F.col("_own") == F.col("_id")).select(
        "text", "toxic", F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(2)).alias("fold"), F.xxhash64("_id", F.lit(2)).alias("pick")
    )


def learn_signs(known: DataFrame) -> tuple[dict[bytes, int], dict[bytes, int]]:
    """The strongest signs and their levels: of all documents, and of fold 0 alone.

    What counts is the number of toxic and of clean documents that hold a feature.
    """
    names = ("clean0", "toxic0", "clean", "toxic")

    def count(batch) -> dict:
        seen = {n: Counter() for n in names}
        folds = batch.column("fold").to_pylist()
        for t, y, fold in zip(texts_of(batch), batch.column("toxic").to_pylist(), folds):
            # The empty feature counts the documents.
            found = {f for w in set(tokens_of(t)) if len(w) < 64 for f in features_of(w)} | {b""}
            label = "toxic" if y > 0 else "clean"
            seen[label].update(found)
            if fold == 0:
                seen[label + "0"].update(found)
        features = list(seen["clean"].keys() | seen["toxic"].keys())
        return {"feature": features} | {n: [seen[n][f] for f in features] for n in names}

    counted = each_batch(known, count, "feature binary, clean0 bigint, toxic0 bigint, clean bigint, toxic bigint")
    counted = counted.groupBy("feature").agg(*(F.sum(n).alias(n) for n in names))
    counted = checkpointed(counted.filter((F.col("toxic") >= LEAST_DOCS) | (F.length("feature") == 0)))
    row = counted.filter(F.length("feature") == 0).first()
    return _strongest(counted, row, "toxic", "clean"), _strongest(counted, row, "toxic0", "clean0")


def _strongest(counted: DataFrame, docs, toxic: str, clean: str) -> dict[bytes, int]:
    if docs is None or not docs[toxic]:
        return {}
    odds = F.log((F.col(toxic) + 0.5) / (docs[toxic] + 1)) - F.log((F.col(clean) + 0.5) / (docs[clean] + 1))
    error = F.sqrt(1 / (F.col(toxic) + 0.5) + 1 / (F.col(clean) + 0.5))
    top = (
        counted.filter((F.length("feature") > 0) & (F.col(toxic) >= LEAST_DOCS))
        .select("feature", (odds - 2 / F.sqrt(toxic)).alias("least"), (odds / error).alias("z"))
        .filter((F.col("least") >= 1) & (F.col("z") >= LEAST_Z))
        .orderBy(F.desc("z"), "feature")
        .limit(SIGNS)
        .collect()
    )
    return {bytes(r["feature"]): min(LEVELS, int(r["least"])) for r in top}


def _picked(df: DataFrame, hash_: str, bound: int) -> DataFrame:
    """About ``bound`` rows of ``df``, those whose hash is small enough."""
    share = min(1.0, bound / max(1, df.count()))
    return df.filter(F.pmod(hash_, F.lit(1_000_000)) < int(share * 1_000_000))


def sampled_stretches(signed: DataFrame) -> Counter:
    """Levels and label of stretches, with how often each occurs among those picked in the order of their hashes."""
    each = signed.select("toxic", "pick", F.posexplode("parts").alias("at", "part"))
    each = each.select("toxic", "part", F.xxhash64("pick", "at", F.lit(3)).alias("hash"))
    rows = _picked(each, "hash", TRAIN_DOCS * TRAIN_PARTS).collect()
    given: Counter = Counter()
    for r in sorted(rows, key=lambda r: (r["hash"], r["part"], r["toxic"])):
        key = bytes(r["part"]), bool(r["toxic"])
        if key not in given and len(given) == TRAIN_STRETCHES:
            break
        given[key] += 1
    return given


def document_summaries(signed: DataFrame, field: Field) -> list:
    """``toxic, surprise, most`` of about ``TRAIN_DOCS`` documents: of all their stretches, as in scoring, in Spark tasks."""
    shared = signed.sparkSession.sparkContext.broadcast(field)

    def work(batch) -> dict:
        found = batch.column("parts").to_pylist()
        p = shared.value.tagged([np.frombuffer(x, dtype=np.uint8) for own in found for x in own])
        sums, used = [], 0
        for own in found:
            sums.append(np.concatenate([np.zeros(0), *p[used : used + len(own)]]))
            used += len(own)
        x = summaries(sums)
        return {"toxic": batch.column("toxic"), "surprise": x[:, 1], "most": x[:, 2]}

    some = _picked(signed, "pick", TRAIN_DOCS)
    return sorted(each_batch(some, work, "toxic int, surprise double, most double").collect())


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> Model:
    """Signs from Spark, then the field and the score weights from a bounded number of stretches and summaries.

    The field and the weights are fitted on fold 1 with the signs of fold 0, so that a word that happens to stand in a few
    toxic documents is met as it will be in texts never seen. The model then takes the signs of both folds.
    """
    known = labelled_texts(docs, labels, id_col, text_col, label_col)
    signs, half = learn_signs(known)
    shared = known.sparkSession.sparkContext.broadcast(half)
    worker: list[Levels] = []

    def levels(batch) -> dict:
        if not worker:
            worker.append(Levels(shared.value))
        found = [list(map(worker[0].__getitem__, tokens_of(t))) for t in texts_of(batch)]
        parts = [[bytes(x[a : z + 1]) for a, z in stretches(x)] for x in found]
        toxic = [int(y > 0) for y in batch.column("toxic").to_pylist()]
        return {"toxic": toxic, "pick": batch.column("pick"), "parts": parts}

    tagged = checkpointed(each_batch(known.filter("fold = 1"), levels, "toxic int, pick bigint, parts array<binary>"))
    signed = tagged.filter(F.size("parts") > 0)
    # A bounded number of stretches, one byte a token, and three numbers a document come to the driver.
    model = Model(signs, fit_field(sampled_stretches(signed)), np.zeros(3))
    rows = document_summaries(signed, model.field)
    y = [float(r["toxic"]) for r in rows]
    share = len(rows) / max(1, signed.count())
    bare = {r["toxic"]: r["count"] for r in tagged.filter(F.size("parts") == 0).groupBy("toxic").count().collect()}
    x, y = np.array([[1.0, r["surprise"], r["most"]] for r in rows]).reshape(-1, 3), np.array(y)
    weights = np.ones(len(y))
    # Documents without a sign all look alike: one row of each label stands for them.
    for label, count in sorted(bare.items()):
        x, y = np.vstack([x, [1.0, 0.0, 0.0]]), np.append(y, float(label))
        weights = np.append(weights, count * share if rows else count)
    model.weights = fit_scores(x, y, weights) if len(y) else np.array([-4.0, 1.0, 1.0])
    return model


def token_offsets(text: bytes) -> list[tuple[int, int]]:
    """Where each token stands in the lower-cased text, in bytes."""
    from tidemark.llm.decontamination import word_offsets

    return word_offsets(text.decode().lower().encode())


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``id, score, predicted, spans`` and the columns of ``keep``.

    ``labels`` (id, label) are all that is learned from; texts are all that is scored. ``spans`` are the stretches of
    tokens more likely toxic than not, as byte offsets [start, end) of the lower-cased text with their largest marginal.

    Null or empty text: the score of a text without signs. Null labels or ids are not learned from; of several labels of
    a document the largest counts. No labels: every score is near 0. Null id: scored like any other. Empty input: no rows.
    """
    spark = prepared(docs.sparkSession)
    shared = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))
    worker: list[Levels] = []

    def work(batch) -> dict:
        model: Model = shared.value
        if not worker:
            worker.append(Levels(model.signs))
        texts = texts_of(batch, text_col)
        tagged = model.tag(texts, worker[0])
        scores = model.scores([p for _, p in tagged])
        spans = []
        for text, (parts, p) in zip(texts, tagged):
            own = []
            if len(p) and p.max() > 0.5:
                places = token_offsets(text)
                at = [i for a, z in parts for i in range(a, z + 1)]
                for i, q in zip(at, p.tolist()):
                    if q > 0.5 and own and own[-1][0] == i - 1:
                        own[-1] = [i, own[-1][1], places[i][1], max(q, own[-1][3])]
                    elif q > 0.5:
                        own.append([i, *places[i], q])
            spans.append([{"start": a, "end": z, "p": q} for _, a, z, q in own])
        return {c: batch.column(c) for c in (id_col, *keep)} | {
            "score": scores,
            "predicted": (scores >= threshold).astype(np.int32),
            "spans": spans,
        }

    fields = [docs.schema[c] for c in (id_col, *keep)]
    found = T.StructType.fromDDL(
        "score double, predicted int, spans array<struct<start: bigint, end: bigint, p: double>>"
    )
    columns = list(dict.fromkeys([id_col, text_col, *keep]))
    return each_batch(docs.select(*columns), work, T.StructType([*fields, *found.fields]))
