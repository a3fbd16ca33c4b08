"""Near-duplicate passages by compact windows.

The tokens of a text are its shingles of five words. Under a hash function every subsequence of tokens has a smallest
token; a compact window (l, c, r) stands for all subsequences that contain place c and lie in l..r, whose smallest token is
that at c. The windows of a text are the nodes of the Cartesian tree over its token hashes; those at least as wide as the
shortest passage number about two per such width, whatever the text. Two similar passages lie in windows of the same
smallest token for most hash functions.

1. Windows of all texts meet by hash function and smallest token. Windows of equal words fold into those of the earliest
   document that holds them, one row for each; of the different ones every two meet. Where a stock phrase brings very many
   together, those meet that share a run of shingles, as every two windows around a similar passage do.
2. Links meet by pair of documents. Intervals covered under enough hash functions are candidate passages.
3. Candidates are verified on the words: matching shingles, and their Jaccard similarity.
4. Verified links join documents into classes.

Pairs grow with the square of the number of texts that share a passage. 2 and 3 go in rounds, each over the pairs of some of the
later documents, so that the disk holds those of one round.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LARGEST, comparable_id, each_batch, prepared, shuffle_parts, stored, texts_of
from tidemark.llm.decontamination import words_of
from tidemark.llm.simhash import components
from tidemark.llm.substrings import PrefixHashes, mixed, sliding_min

SHINGLE, SIMILARITY = 5, 0.8
LEAST_WORDS = 50
# Hash functions, and how many of them have to agree on a passage before it is verified.
HASHES, ENOUGH = 5, 2
CHUNK_BYTES = 1 << 20
# Different windows of a key of which every two meet; of more, those that share ``RUN`` shingles in a row.
BLOCK = 64
# A passage has at least LEAST_WORDS - SHINGLE + 1 = 46 places, 8 / 9 of them matching. Between two runs of matches lie at least
# SHINGLE - 1 others: one gap leaves a run of 21, more gaps longer ones. A seed is ``SEED`` shingles in a row.
RUN, SEED = 20, 12
# What goes through the shuffles of a round, for each of their partitions: pairs of windows, and bytes of text to compare.
PAIRS, PIECES, WORD_BYTES = 250_000, 16 << 20, 7
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _stored(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored`; the shuffles that made the frame leave the disk once it is written, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(CLEANUP, before)


def _rounds(amount: float, most: int, parts: int) -> int:
    return max(1, -(-int(amount) // (most * parts)))


def _in_round(doc: str, turn: int, rounds: int) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(rounds)) == turn if rounds > 1 else F.lit(True)


def _in_turn(rounds: int, make: Callable[[int], DataFrame], name: str) -> DataFrame:
    """The frames of all rounds together. Each is stored, and its shuffles leave the disk, before the next one begins."""
    return reduce(DataFrame.unionAll, [_stored(make(turn), name) for turn in range(rounds)])


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """One hash per word place: of the shingle that starts there, for the last four words of a few words less."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    hashes = PrefixHashes(np.frombuffer(b" ".join(words), dtype=np.uint8))
    last = np.minimum(np.arange(len(words)) + SHINGLE - 1, len(words) - 1)
    return mixed(hashes.of(end - size, end[last]))


def compact_windows(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Windows (l, c, r) at least ``least`` wide over token values; a value of 0 separates texts.

    Of equal values the leftmost counts as the smallest. A place has a wide window if and only if it is the smallest of some
    ``least`` places in a row, and then so have the smaller places that bound its window: the tree is built over those
    places alone.
    """
    n = len(values)
    if n < least:
        return []
    lowest = sliding_min(values, least)
    padded = np.concatenate([np.zeros(least - 1, dtype=np.uint64), lowest, np.zeros(least - 1, dtype=np.uint64)])
    reached = ~sliding_min(~padded, least)
    places = np.flatnonzero((reached == values) & (values > 0))
    walls = np.flatnonzero(values == 0)
    items = np.union1d(places, walls)
    out: list[tuple[int, int, int]] = []
    # Open windows, values rising: (place, value, left end).
    stack: list[tuple[int, int, int]] = []
    for at, value in zip(items.tolist(), values[items].tolist()):
        while stack and stack[-1][1] > value:
            c, _, left = stack.pop()
            if at - left >= least:
                out.append((left, c, at - 1))
        if value == 0:
            stack = [(at, 0, at)]
        else:
            stack.append((at, value, stack[-1][0] + 1 if stack else 0))
    while stack:
        c, value, left = stack.pop()
        if value and n - left >= least:
            out.append((left, c, n - 1))
    return out


def windows(docs: DataFrame, least: int, hashes: int) -> DataFrame:
    """``key, words, doc, l, r``: all wide compact windows, the low digits of a key name the hash function; ``words`` is a hash of
    the words of l..r.
    """

    def work(batch) -> dict:
        out: list[np.ndarray] = []
        texts, ids = texts_of(batch), batch.column("doc").to_pylist()
        at = 0
        while at < len(texts):
            words, first, docs_here, held = [], [], [], 0
            while at < len(texts) and held < CHUNK_BYTES:
                own = words_of(texts[at])
                first.append(len(words))
                docs_here.append(ids[at])
                words += own
                held += len(texts[at])
                at += 1
            starts = np.array(first, dtype=np.int64)
            tokens = shingle_hashes(words)
            length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            end = np.cumsum(length + 1) - 1
            hashes_of = PrefixHashes(np.frombuffer(b" ".join(words), dtype=np.uint8)).of if words else None
            ends = np.append(starts[1:], len(words))
            # Shingles that would reach into the next text become walls.
            wall = np.zeros(len(words), dtype=bool)
            for k in range(1, SHINGLE):
                wall[(ends - k)[ends - k >= starts]] = True
            for k in range(hashes):
                values = np.maximum(mixed(tokens + np.uint64((0xD1B54A32D192ED03 * (k + 1)) % (1 << 64))), np.uint64(1))
                values[wall] = 0
                found = np.array(compact_windows(values, least), dtype=np.int64).reshape(-1, 3)
                if len(found):
                    owner = np.searchsorted(starts, found[:, 1], side="right") - 1
                    key = (values[found[:, 1]] // np.uint64(hashes) * np.uint64(hashes) + np.uint64(k)).view(np.int64)
                    ids_ = np.array(docs_here, dtype=np.int64)[owner]
                    rows = _joined(np.stack([key, ids_, *found.T]), owner)
                    lo, hi = rows[2], rows[4]
                    text = mixed(hashes_of(end[lo] - length[lo], end[hi + SHINGLE - 1])).view(np.int64)
                    shift = starts[np.searchsorted(starts, rows[3], side="right") - 1]
                    out.append(np.stack([rows[0], text, rows[1], lo - shift, hi - shift]))
        rows = np.concatenate(out, axis=1) if out else np.zeros((5, 0), dtype=np.int64)
        return {n: rows[i] if i < 3 else rows[i].astype(np.int32) for i, n in enumerate(("key", "words", "doc", "l", "r"))}

    return each_batch(docs, work, "key bigint, words bigint, doc bigint, l int, r int")


def _joined(rows: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Rows (key, doc, l, c, r) with overlapping windows of a key in a text joined.

    A text that repeats itself has a window for every repetition; what counts later is which places they cover.
    """
    rows, owner = (x[..., order] for order in [np.lexsort((rows[2], rows[0], owner))] for x in (rows, owner))
    again = np.zeros(len(owner), dtype=bool)
    again[1:] = (owner[1:] == owner[:-1]) & (rows[0, 1:] == rows[0, :-1])
    keep, last = np.ones(len(owner), dtype=bool), 0
    for i in np.flatnonzero(again).tolist():
        if not again[i - 1]:
            last = i - 1
        if rows[2, i] <= rows[4, last] + 1:
            rows[4, last] = max(rows[4, last], rows[4, i])
            keep[i] = False
        else:
            last = i
    return rows[:, keep]


def folded(found: DataFrame) -> DataFrame:
    """``key, doc, l, r, at, b, b_l, b_r``: windows that share their key with another one.

    Windows of the earliest document that holds their words, at every place, are numbered by ``at`` within their key. The
    others have -1 there, and the first such window of the earliest document in b.
    """
    ordered = found.repartition(shuffle_parts(found.sparkSession), "key").sortWithinPartitions("key", "words", "doc", "l")
    schema = T.StructType.fromDDL("key bigint, doc bigint, l int, r int, at bigint, b bigint, b_l int, b_r int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        # Of the last row settled: key and words, the window it folds into (doc, l, r), numbers given within its key.
        last, base, given = None, np.zeros((3, 1), dtype=np.int64), 0

        def settle(x: np.ndarray, following: int | None) -> pa.RecordBatch:
            nonlocal last, base, given
            key, words, doc = x[:3]
            other_key, other = np.ones(len(key), dtype=bool), np.ones(len(key), dtype=bool)
            other_key[1:] = key[1:] != key[:-1]
            other[1:] = other_key[1:] | (words[1:] != words[:-1])
            if last is not None:
                other_key[0], other[0] = key[0] != last[0], (key[0], words[0]) != last
            bases = np.concatenate([base, x[2:, np.flatnonzero(other)]], axis=1)[:, np.cumsum(other)]
            first = doc == bases[0]
            before = np.cumsum(first) - first
            at = before - np.append(-given, before[other_key])[np.cumsum(other_key)]
            ends = np.append(key[1:] != key[:-1], following is None or key[-1] != following)
            met = ~(other_key & ends)
            last, base, given = (key[-1], words[-1]), bases[:, -1:], int(at[-1] + first[-1])
            arrays = (v[met] for v in (key, doc, x[3], x[4], np.where(first, at, -1), *bases))
            return pa.RecordBatch.from_arrays([pa.array(v.astype(f.type.to_pandas_dtype())) for v, f in zip(arrays, target)], schema=target)

        held = np.zeros((5, 0), dtype=np.int64)
        for batch in batches:
            new = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)])
            x = np.concatenate([held, new], axis=1)
            if x.shape[1] > 1:
                yield settle(x[:, :-1], int(x[0, -1]))
            held = x[:, -1:]
        if held.shape[1]:
            yield settle(held, None)

    return ordered.mapInArrow(run, schema)


def seeds(words: list[bytes], run: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of seeds: in any ``run`` shingles in a row, the ``seed`` shingles in a row with the smallest hash."""
    width, wide = run - seed + 1, seed + SHINGLE - 1
    n = len(words) - wide + 1
    if n < width:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    end = np.cumsum(size + 1) - 1
    values = mixed(PrefixHashes(np.frombuffer(b" ".join(words), dtype=np.uint8)).of((end - size)[:n], end[wide - 1 :]))
    padding = np.zeros(width - 1, dtype=np.uint64)
    reached = ~sliding_min(~np.concatenate([padding, sliding_min(values, width), padding]), width)
    places = np.flatnonzero(reached == values)
    return places, values[places]


def seeded(docs: DataFrame, many: DataFrame, run: int, seed: int) -> DataFrame:
    """``seed, before, id, doc``: a row for every seed of every window, with the seed before it in the text."""
    listed = many.groupBy("doc").agg(F.collect_list(F.struct("id", "key", "l", "r")).alias("windows"))

    def work(batch) -> dict:
        out: list[np.ndarray] = []
        for t, doc, given in zip(texts_of(batch), batch.column("doc").to_pylist(), batch.column("windows").to_pylist()):
            places, values = seeds(words_of(t), run, seed)
            for w in given:
                lo, hi = np.searchsorted(places, (w["l"], w["r"] - seed + 2))
                if lo < hi:
                    own, first = np.unique(values[lo:hi], return_index=True)
                    before = np.where(first > 0, values[np.maximum(lo + first - 1, 0)], np.uint64(0))
                    key = np.uint64(w["key"] % (1 << 64) * 0xD1B54A32D192ED03 % (1 << 64))
                    ids, docs_ = (np.full(len(own), x, dtype=np.int64) for x in (w["id"], doc))
                    out.append(np.stack([mixed(own ^ key).view(np.int64), before.view(np.int64), ids, docs_]))
        rows = np.concatenate(out, axis=1) if out else np.zeros((4, 0), dtype=np.int64)
        return dict(zip(("seed", "before", "id", "doc"), rows))

    return each_batch(docs.join(listed, "doc"), work, "seed bigint, before bigint, id bigint, doc bigint")


def meetings(
    docs: DataFrame, found: DataFrame, hashes: int, run: int, seed: int, then: Callable[[DataFrame], DataFrame] = lambda met: met
) -> DataFrame:
    """``a, b, k`` and both windows, ``also``: every two different windows of a key, b in the earlier document. Or what ``then``
    makes of them, in rounds: all meetings of a document a are in one.

    Of a key with more than ``BLOCK`` different windows, every two that share ``run`` shingles in a row: they share a seed, and
    where they share the one before it as well they have met there already. A folded window meets
    the one it folds into, and no other. ``also`` has a bit for each other hash function under which
    the pair may have met, had not a window at that place of a or b been folded into one of a third document; a folded window
    and its own have all bits, as equal words need no second function.
    """
    parts = shuffle_parts(docs.sparkSession)
    rows = _stored(folded(found), "passage-windows")
    rows = rows.withColumn("k", _function(hashes))
    away, own = rows.filter("at < 0"), rows.filter("at >= 0").select("key", "k", "doc", "l", "r", "at")
    equal = away.filter("doc > b").select(
        F.col("doc").alias("a"), "b", "k", F.col("l").alias("a_l"), F.col("r").alias("a_r"), "b_l", "b_r",
        F.lit((1 << hashes) - 1).cast("bigint").alias("also"),
    )
    sizes = own.groupBy("key").agg(F.max("at").alias("most"), F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    many = own.join(sizes.filter("most > 0 AND lo < hi").select("key", "most"), "key")
    gone = away.groupBy("doc").agg(F.collect_list(F.struct("k", "l", "r")).alias("gone"))
    bits = "coalesce(aggregate(gone, 0L, (s, w) -> if(w.l <= r AND w.r >= l, s | shiftleft(1L, w.k), s)), 0L)"
    many = many.join(gone, "doc", "left").withColumn("also", F.expr(bits)).drop("gone")
    many = _stored(many.withColumn("id", F.monotonically_increasing_id()), "passage-different")
    few, more = many.filter(F.col("most") < BLOCK), many.filter(F.col("most") >= BLOCK)
    seeds_ = _stored(seeded(docs, more, run, seed), "passage-seeds")
    # A window of a key with ``most`` others meets half of them as the later one, and so does one of a seed.
    of_few = few.agg(F.sum("most")).first()[0] or 0
    of_seeds = seeds_.groupBy("seed").count().agg(F.sum(F.col("count") * (F.col("count") - 1))).first()[0] or 0
    rounds = _rounds((of_few + of_seeds) / 2, PAIRS, parts)
    columns = ("k", "doc", "l", "r", "also")

    def side(of: DataFrame, name: str) -> DataFrame:
        return of.select("key", *(F.col(c).alias(f"{name}_{c}") for c in ("id", *columns)))

    def meet(turn: int) -> DataFrame:
        mine = _in_round("doc", turn, rounds)
        pairs = side(few.filter(mine), "x").join(side(few, "y"), "key").filter("x_doc > y_doc")
        x, y = (of.select("seed", *(F.col(c).alias(f"{n}_{c}") for c in ("before", "id", "doc"))) for of, n in ((seeds_.filter(mine), "x"), (seeds_, "y")))
        met = x.join(y, "seed").filter("x_doc > y_doc AND (x_before <> y_before OR x_before = 0)").select("x_id", "y_id").distinct()
        shared = met.join(side(more.filter(mine), "x"), "x_id").join(side(more, "y"), ["y_id", "key"])
        different = pairs.unionByName(shared).select(
            F.col("x_doc").alias("a"), F.col("y_doc").alias("b"), F.col("x_k").alias("k"), F.col("x_l").alias("a_l"), F.col("x_r").alias("a_r"),
            F.col("y_l").alias("b_l"), F.col("y_r").alias("b_r"), F.col("x_also").bitwiseOR(F.col("y_also")).alias("also"),
        )
        return then(equal.filter(_in_round("a", turn, rounds)).unionAll(different))

    return _in_turn(rounds, meet, "passage-candidates")


def _function(hashes: int):
    """The hash function of ``key``: the remainder of its unsigned value."""
    high, low = F.shiftrightunsigned("key", 1), F.col("key").bitwiseAND(F.lit(1).cast("bigint"))
    return F.pmod(F.pmod(high, F.lit(hashes)) * 2 + low, F.lit(hashes)).cast("int")


def covered(rows: list[tuple], least: int, enough: int) -> list[tuple[int, int, int, int]]:
    """Stretches of a's places inside windows of ``enough`` hash functions, with the stretch of b that goes with each.

    ``rows``: (k, a_l, a_r, b_l, b_r, also); the functions of the bits of ``also`` count next to k.
    """
    functions = [1 << r[0] | r[5] for r in rows]
    if int(np.bitwise_or.reduce(functions)).bit_count() < enough:
        return []
    each = [(r, k) for r, bits in zip(rows, functions) for k in range(bits.bit_length()) if bits >> k & 1]
    events = sorted([(r[1], 0, k) for r, k in each] + [(r[2] + 1, 1, k) for r, k in each], key=lambda e: (e[0], -e[1]))
    open_: dict[int, int] = {}
    stretches, since = [], None
    for at, ends, k in events:
        open_[k] = open_.get(k, 0) + (-1 if ends else 1)
        if not open_[k]:
            del open_[k]
        if since is None and len(open_) >= enough:
            since = at
        elif since is not None and len(open_) < enough:
            stretches.append((since, at - 1))
            since = None
    # Neighbouring stretches are one: a window may end where another of its hash function begins.
    merged: list[list[int]] = []
    for lo, hi in stretches:
        if merged and lo <= merged[-1][1] + 1:
            merged[-1][1] = max(hi, merged[-1][1])
        else:
            merged.append([lo, hi])
    out = []
    for lo, hi in merged:
        if hi - lo + 1 >= least:
            own = [r for r in rows if r[1] <= hi and r[2] >= lo]
            out.append((lo, hi, min(r[3] for r in own), max(r[4] for r in own)))
    return out


def candidates(met: DataFrame, least: int, enough: int) -> DataFrame:
    """``a, a_lo, a_hi, b, b_lo, b_hi``: stretches of shingles to compare."""
    ordered = met.repartition(shuffle_parts(met.sparkSession), "a", "b").sortWithinPartitions("a", "b")
    schema = T.StructType.fromDDL("a bigint, a_lo int, a_hi int, b bigint, b_lo int, b_hi int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)

        def settle(found):
            columns = list(zip(*found)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, target)], schema=target)

        def close(x: np.ndarray) -> pa.RecordBatch:
            found = []
            if x.shape[1]:
                first = np.flatnonzero(np.append(True, (x[:2, 1:] != x[:2, :-1]).any(axis=0)))
                functions = np.bitwise_or.reduceat(np.left_shift(1, x[2]) | x[7], first)
                ends = np.append(first[1:], x.shape[1])
                for i in np.flatnonzero(np.bitwise_count(functions) >= enough).tolist():
                    rows = [tuple(r) for r in x[2:, first[i] : ends[i]].T.tolist()]
                    a, b = x[:2, first[i]].tolist()
                    for a_lo, a_hi, b_lo, b_hi in covered(rows, least, enough):
                        found.append((a, a_lo, a_hi, b, b_lo, b_hi))
            return settle(found)

        # Whole pairs at a time: what is held over is bounded by the windows of a document.
        held = np.zeros((8, 0), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = np.concatenate([held, np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(8)])], axis=1)
                last = int(np.argmax((x[:2] == x[:2, -1:]).all(axis=0)))
                yield close(x[:, :last])
                held = x[:, last:]
        yield close(held)

    return ordered.mapInArrow(run, schema)


def dense(match: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Maximal stretches of places, first and last one matching, that hold at least ``similarity`` matches.

    A match scores 1 - similarity, any other place -similarity; the stretches are the maximal scoring ones: no stretch
    can be widened without a loss.
    """
    turn = np.flatnonzero(np.diff(np.concatenate(([0], match.astype(np.int8), [0]))))
    runs_ = [(int(a), int(z) - 1) for a, z in zip(turn[::2], turn[1::2])]
    done: list[list] = []
    total = 0.0
    # Each open stretch: first place, last place, score before it, score up to its end.
    before = None
    for a, z in runs_:
        if before is not None:
            total -= similarity * (a - before - 1)
        before = z
        now = [a, z, total, total + (1 - similarity) * (z - a + 1)]
        total = now[3]
        while True:
            j = len(done) - 1
            while j >= 0 and done[j][2] >= now[2]:
                j -= 1
            if j < 0 or done[j][3] >= now[3]:
                done.append(now)
                break
            now = [done[j][0], now[1], done[j][2], now[3]]
            del done[j:]
    return [(d[0], d[1]) for d in done]


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    mine, other = set(a.tolist()), set(b.tolist())
    both = len(mine & other)
    return both / max(1, len(mine) + len(other) - both)


def _repeated(x: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Place, length and value of stretches of one shingle at least ``least`` long."""
    first = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(first, len(x)))
    long = size >= least
    return list(zip(first[long].tolist(), size[long].tolist(), x[first[long]].tolist()))


def common_passages(
    a: np.ndarray, b: np.ndarray, least: int, similarity: float
) -> list[tuple[int, int, int, int, float]]:
    """Passages (a first, a last, b first, b last, Jaccard) of at least ``least`` shingles that are similar enough.

    Shingles that both hold tell diagonals (place in b minus place in a). Along each, and ``SHINGLE`` places to its sides for
    inserted and left-out words, dense stretches are compared as sets; where one is not similar enough as a whole, its
    stretches without any difference stand for themselves.
    """
    # As many equal shingles as a similar passage has to have at the least, if two passages are of one length.
    density = 2 * similarity / (1 + similarity)
    out: list[tuple[int, int, int, int, float]] = []
    order = np.argsort(b, kind="stable")
    ranked = b[order]
    first, last = np.searchsorted(ranked, a), np.searchsorted(ranked, a, side="right")
    held = np.flatnonzero(last > first)
    if len(held) < least * density - 1e-6:
        return out
    # Shifts and their counts, from n - SHINGLE up; of equally frequent ones the first along a goes first.
    n, m = len(a), len(b)
    first, last = order[first[held]], order[last[held] - 1]
    steps = np.stack([first, np.where(last > first, last, -1)], axis=1) - held[:, None]
    steps = steps[np.stack([np.ones(len(held), dtype=bool), last > first], axis=1)] + n + SHINGLE
    counts = np.bincount(steps, minlength=n + m + 2 * SHINGLE + 1)
    rank = np.full(len(counts), len(steps))
    np.minimum.at(rank, steps, np.arange(len(steps)))
    # A shingle repeated over a passage is everywhere: its stretch in b need be neither the first nor the last place.
    there = {value: start for start, _, value in reversed(_repeated(b, least))}
    for start, size, value in _repeated(a, least):
        if value in there:
            counts[there[value] - start + n + SHINGLE] += size
    # b between places that equal none of a: 0 is no shingle's hash.
    wide = np.zeros(m + 2 * (n + SHINGLE), dtype=np.uint64)
    wide[n + SHINGLE : n + SHINGLE + m] = b
    while True:
        top = np.flatnonzero(counts == counts.max())
        at = int(top[np.argmin(rank[top])])
        if counts[at - SHINGLE : at + SHINGLE + 1].sum() < least * density / (2 * SHINGLE):
            break
        counts[at - SHINGLE : at + SHINGLE + 1] = 0
        shift = at - n - SHINGLE
        same = np.ndarray((2 * SHINGLE + 1, n), dtype=np.uint64, buffer=wide, offset=8 * (at - SHINGLE), strides=(8, 8)) == a
        match, exact = same.any(axis=0), same[SHINGLE]
        if np.count_nonzero(match) < least * similarity - 1e-6:
            continue
        for lo, hi in dense(match, density):
            if hi - lo + 1 >= least:
                start, end = max(0, lo + shift), min(m, hi + shift + 1)
                found = _jaccard(a[lo : hi + 1], b[start:end])
                if found >= similarity:
                    out.append((lo, hi, start, end - 1, found))
        turn = np.flatnonzero(np.diff(np.concatenate(([0], exact.astype(np.int8), [0]))))
        for lo, end in zip(turn[::2].tolist(), turn[1::2].tolist()):
            if end - lo >= least and not any(x[0] <= lo and end - 1 <= x[1] for x in out):
                out.append((lo, end - 1, lo + shift, end - 1 + shift, 1.0))
    return out


def verify(docs: DataFrame, others: DataFrame, cands: DataFrame, least: int, similarity: float) -> DataFrame:
    """``doc, n_words, passages``: what holds of the candidates of every document. ``others`` have the texts of b.

    The stretches of b are cut from the texts once each, however many documents are compared with them. Where fewer shingles of a
    are in b than a passage has to match, there is none.
    """
    matches = least * 2 * similarity / (1 + similarity)
    parts = shuffle_parts(docs.sparkSession)
    texts, others = docs.repartition(parts, "doc"), others.repartition(parts, "doc")
    asked = cands.select("b", "b_lo", "b_hi").distinct()
    asked = asked.groupBy(F.col("b").alias("doc")).agg(F.collect_list(F.struct("b_lo", "b_hi")).alias("asked"))

    def cut(batch) -> dict:
        out: dict[str, list] = {k: [] for k in ("b", "b_lo", "b_hi", "piece")}
        for t, doc, ranges in zip(texts_of(batch), batch.column("doc").to_pylist(), batch.column("asked").to_pylist()):
            words = words_of(t)
            for r in ranges:
                values = (doc, r["b_lo"], r["b_hi"], b" ".join(words[r["b_lo"] : r["b_hi"] + SHINGLE]))
                for name, value in zip(out, values):
                    out[name].append(value)
        return out

    pieces = each_batch(others.join(asked, "doc"), cut, "b bigint, b_lo int, b_hi int, piece binary")
    pairs = cands.join(pieces, ["b", "b_lo", "b_hi"]).repartition(parts, "a")
    listed = pairs.groupBy(F.col("a").alias("doc")).agg(
        F.collect_list(F.struct("a_lo", "a_hi", "b", "b_lo", "piece")).alias("pieces")
    )

    def compare(batch) -> dict:
        n_words, passages = [], []
        for t, given in zip(texts_of(batch), batch.column("pieces").to_pylist()):
            words = words_of(t)
            n_words.append(len(words))
            own = shingle_hashes(words)[: max(0, len(words) - SHINGLE + 1)] if given else None
            found = set()
            for g in given or ():
                other = shingle_hashes(g["piece"].split())
                other = other[: max(0, len(other) - SHINGLE + 1)]
                mine = own[g["a_lo"] : g["a_hi"] + 1]
                if np.count_nonzero(np.isin(mine, other)) < matches - 1e-6:
                    continue
                for lo, hi, first, last, jaccard in common_passages(mine, other, least, similarity):
                    start, start_b = lo + g["a_lo"], first + g["b_lo"]
                    found.add((start, hi + g["a_lo"] + SHINGLE, g["b"], start_b, last + g["b_lo"] + SHINGLE, jaccard))
            names = ("start", "end", "other", "other_start", "other_end", "similarity")
            passages.append([dict(zip(names, x)) for x in sorted(found)])
        return {"doc": batch.column("doc"), "_id": batch.column("_id"), "n_words": n_words, "passages": passages}

    struct = "start: int, end: int, other: bigint, other_start: int, other_end: int, similarity: double"
    schema = T.StructType(
        [docs.schema["doc"], docs.schema["_id"], *T.StructType.fromDDL(f"n_words bigint, passages array<struct<{struct}>>").fields]
    )
    return each_batch(texts.join(listed, "doc", "left"), compare, schema)


def near_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    similarity: float = SIMILARITY,
    hashes: int = HASHES,
    enough: int = ENOUGH,
) -> DataFrame:
    """One row per document: ``id, n_words, passages, class_id, n_links``.

    ``passages``: stretches of at least ``least_words`` words (places [start, end) in the words of the text) whose
    five-word shingles have a Jaccard similarity of ``similarity`` or more with a stretch of the earlier document ``other``.
    A passage is compared with every different one that has its smallest shingles; of equal windows only the earliest
    document's is compared, and the later ones are linked to it. Documents with verified passages form classes, named by the
    smallest id. ``n_links``: documents that a document is linked to directly, in either direction.

    Words are those of ASCII letters, digits and all that is not ASCII, in lower case. Null, empty or shorter text: no
    passages, a class of its own. Rows of one id are one document: linked once, each row with its own text's passages.
    Null id: larger than every other, class null if alone. Empty input: no rows. A passage is missed if fewer than
    ``enough`` of the ``hashes`` functions agree on it.
    """
    spark = prepared(docs.sparkSession)
    least = least_words - SHINGLE + 1
    own = docs.select(comparable_id(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(id_col).alias("_id"))
    texts = own.select("doc", "text")
    cands = meetings(texts, windows(texts, least, hashes), hashes, RUN, SEED, lambda met: candidates(met, least, enough))
    size = cands.agg(F.sum(F.col("b_hi") - F.col("b_lo") + SHINGLE)).first()[0] or 0
    rounds = _rounds(WORD_BYTES * size, PIECES, shuffle_parts(spark))

    def checked(turn: int) -> DataFrame:
        return verify(own.filter(_in_round("doc", turn, rounds)), own, cands.filter(_in_round("a", turn, rounds)), least, similarity)

    found = _in_turn(rounds, checked, "passages")
    edges = found.select(F.col("doc").alias("a"), F.explode("passages.other").alias("b")).distinct()
    edges = _stored(edges, "passage-links")
    classes = components(edges)
    both = edges.select(F.col("a").alias("node")).unionAll(edges.select(F.col("b").alias("node")))
    degree = both.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    out = found.join(classes.withColumnRenamed("node", "doc"), "doc", "left")
    out = out.join(degree.withColumnRenamed("node", "doc"), "doc", "left")
    class_id = F.coalesce("component", "doc")
    return out.select(
        F.col("_id").alias(id_col),
        "n_words",
        "passages",
        F.when(class_id != LARGEST, class_id).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )
