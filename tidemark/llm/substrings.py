"""Suffix-array deduplication: bytes of strings that an earlier document holds as well are removed.

A text has one suffix per byte; sorting them all over a corpus would move the corpus many times over. Every window of
``length`` bytes has an anchor, its substring of ``length // 3`` bytes with the smallest hash, and equal windows have equal
anchors. So anchors, one for some twenty bytes, are shuffled first:

1. A run is a stretch of consecutive windows with one anchor; its context is the text that these windows cover. Rows
   (anchor, context, document), as hashes, meet by anchor. An anchor in one document only ends here. A context that an
   earlier document holds is removed as a whole. What remains are contexts that are the first of their kind beside
   others of the same anchor.
2. Those contexts, as text, meet by anchor. Their windows are suffixes of the joined contexts. They are merge-sorted,
   two suffixes compared by the longest common extension, found by binary search over prefix polynomial
   hashes; neighbours that agree in ``length`` bytes form classes, verified byte by byte. A window whose class has an earlier
   document is removed.
3. Removed windows return to the texts by document id.

An anchor with more than ``BIG`` distinct contexts is not gathered: its contexts go on window by window, each under its own
hash, where only the earliest of equal ones has to be remembered.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import comparable_id, each_batch, prepared, shuffle_parts, stored, texts_of

LENGTH = 50
BIG = 100_000
# Text that is sorted at a time.
BLOB_BYTES = 1 << 20
# Texts that are hashed together; of a longer one, the whole.
PIECE_BYTES = 60_000

_BASE = 0x9E3779B97F4A7C15
WHOLE, CONTEXT, WINDOWS = 1, 2, 3


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = np.ones(size, dtype=np.uint64), np.ones(size, dtype=np.uint64)
    up[1:], down[1:] = _BASE, pow(_BASE, -1, 1 << 64)
    return np.cumprod(up), np.cumprod(down)


class PrefixHashes:
    """Polynomial hashes of all prefixes; the hash of any substring takes two of them."""

    def __init__(self, text: np.ndarray):
        size = 1 << max(16, int(len(text) + 1).bit_length())
        self.up, self.down = _powers(size)
        self.sums = np.zeros(len(text) + 1, dtype=np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * self.up[: len(text)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, step = len(x) - width + 1, 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:n], x[width - step : width - step + n]) if step < width else x[:n]


def pieces(texts: list[bytes], wanted: np.ndarray | None = None) -> Iterator[list[int]]:
    """Places of the ``wanted`` texts (all by default), as many at a time as ``PIECE_BYTES`` hold."""
    some, held = [], 0
    for i in range(len(texts)) if wanted is None else np.flatnonzero(wanted).tolist():
        if some and held + len(texts[i]) > PIECE_BYTES:
            yield some
            some, held = [], 0
        some.append(i)
        held += len(texts[i])
    if some:
        yield some


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first window, number of windows, anchor and context hash of each run, in the order of the texts.

    Windows are counted in the joined texts, and lie in one text each. A run that would hold more windows than an anchor can
    (repetitive text) is cut.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = len(data) - length + 1
    if n < 1:
        return (*(np.zeros(0, dtype=np.int64) for _ in range(5)),)
    size = max(1, length // 3)
    most = length - size + 1
    hashes = PrefixHashes(data)
    long = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(long)
    begins = ends - long
    at = len(data) - size + 1
    least = sliding_min(mixed(hashes.of(slice(0, at), slice(size, size + at))), most)
    new = np.ones(n, dtype=bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[begins[begins < n]] = True
    # A window that would reach into the next text is none.
    new &= np.arange(length, n + length) <= np.repeat(ends, long)[:n]
    first = np.flatnonzero(new)
    row = np.searchsorted(begins, first, side="right") - 1
    count = np.minimum(np.append(first[1:], n), ends[row] - length + 1) - first
    if (count > most).any():
        parts = -(-count // most)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        left = np.repeat(count, parts) - nth * most
        row, first, count = np.repeat(row, parts), np.repeat(first, parts) + nth * most, np.minimum(left, most)
    context = mixed(hashes.of(first, first + count - 1 + length) ^ (count.astype(np.uint64) * np.uint64(_BASE)))
    return row, first, count, least[first].view(np.int64), context.view(np.int64)


def _codes(row: np.ndarray, context: np.ndarray, asked_row: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where text and context are, for runs and for what is asked of them."""
    values, code = np.unique(np.concatenate([context, asked]), return_inverse=True)
    return row * len(values) + code[: len(row)], asked_row * len(values) + code[len(row) :]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - start, size)


class Listed:
    """The values of a column of lists, by the row that holds them."""

    def __init__(self, column: pa.ListArray):
        size = np.diff(column.offsets.to_numpy()) if not column.null_count else pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        self.values, self.ends = column.flatten(), np.cumsum(size)
        self.size = size

    def of(self, rows: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``rows`` holds each of their values, and the places of these."""
        size = self.size[rows]
        return np.repeat(np.arange(len(rows)), size), _ranges(self.ends[rows] - size, size)


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """``anchor, context, doc``, each once per document row."""

    def work(batch) -> dict:
        found = [[], [], []]
        texts, docs = texts_of(batch), batch.column("doc").to_numpy()
        for some in pieces(texts):
            row, _, _, anchor, context = runs([texts[i] for i in some], length)
            order = np.lexsort((anchor, context, row))
            order = order[_starts(row[order], context[order], anchor[order])] if len(order) else order
            for column, values in zip(found, (anchor[order], context[order], docs[some][row[order]])):
                column.append(values)
        none = [np.zeros(0, dtype=np.int64)]
        return dict(zip(("anchor", "context", "doc"), (np.concatenate(x or none) for x in found)))

    return each_batch(docs, work, "anchor bigint, context bigint, doc bigint")


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Places where any of the sorted keys changes."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def candidates(rows: DataFrame, big: int) -> DataFrame:
    """``doc, context, kind``: WHOLE contexts to remove, and those that need a look at their windows."""
    spark = rows.sparkSession
    ordered = rows.repartition(shuffle_parts(spark), "anchor").sortWithinPartitions("anchor", "context", "doc")
    schema = T.StructType.fromDDL("doc bigint, context bigint, kind int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        # Of the anchor at the end of the last batch: first rows of its contexts that are not yet told, whether
        # it spans documents, whether it is big.
        held, spans, large = np.zeros((3, 0), dtype=np.int64), False, False

        def told(doc, context, kind):
            arrays = [pa.array(doc), pa.array(context), pa.array(np.full(len(doc), kind, dtype=np.int32))]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        def settle(first, group_spans):
            """Contexts of complete anchors: those beside others, if there is more than one document."""
            begin = _starts(first[0])
            size = np.diff(np.append(begin, first.shape[1]))
            low, high = np.minimum.reduceat(first[2], begin), np.maximum.reduceat(first[2], begin)
            keep = np.repeat((size > 1) & ((low < high) | group_spans[begin]), size)
            return told(first[2][keep], first[1][keep], CONTEXT)

        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.stack([batch.column(i).to_numpy() for i in range(3)])
            x = np.concatenate([held, new], axis=1)
            lead = _starts(x[0], x[1])
            base = np.repeat(x[2][lead], np.diff(np.append(lead, x.shape[1])))
            later = x[2] > base
            if later.any():
                yield told(x[2][later], x[1][later], WHOLE)
            first = x[:, lead]
            # An anchor also spans documents if one of its contexts does.
            crossing = np.maximum.reduceat(later, lead)
            begin = _starts(first[0])
            group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, first.shape[1])))
            crosses = np.maximum.reduceat(crossing, begin)[group]
            if spans:
                crosses = crosses | (group == 0)
            last = begin[-1]
            if large:
                # The big anchor goes on: its new first rows are told at once; held keeps the last context only.
                own = group == 0
                own[0] = False
                yield told(first[2][own], first[1][own], WINDOWS)
                if last == 0:
                    held, spans = first[:, -1:], True
                    continue
                large, rest = False, begin[1]
            else:
                rest = 0
            if last > rest:
                yield settle(first[:, rest:last], crosses[rest:last])
            held, spans = first[:, last:], bool(crosses[-1])
            if held.shape[1] > big:
                yield told(held[2], held[1], WINDOWS)
                held, spans, large = held[:, -1:], True, True
        if held.shape[1] and not large:
            yield settle(held, np.full(held.shape[1], spans))

    return ordered.mapInArrow(run, schema)


def contexts(docs: DataFrame, length: int) -> DataFrame:
    """``key, content, doc, context, at``: text of the contexts listed in ``look`` (whole) and ``split`` (by window).

    ``key`` is what equal windows share: the anchor, or the window's own hash. ``at`` is the window's place in a context
    that is split, else 0.
    """

    def work(batch) -> dict:
        out: dict[str, list] = {k: [] for k in ("key", "content", "doc", "context", "at")}

        def put(key, content, doc, context, at):
            for name, value in zip(out, (key, content, doc, context, at)):
                out[name].append(value)

        texts, docs = texts_of(batch), batch.column("doc").to_numpy()
        look, split = Listed(batch.column("look")), Listed(batch.column("split"))
        for some in pieces(texts, look.size + split.size > 0):
            own = [texts[i] for i in some]
            row, first, count, anchor, context = runs(own, length)
            (whole, at), (parted, at_split) = look.of(some), split.of(some)
            asked = np.concatenate([look.values.to_numpy()[at], split.values.to_numpy()[at_split]])
            code, wanted = _codes(row, context, np.concatenate([whole, parted]), asked)
            listed, once = np.unique(code, return_index=True)
            k = once[np.isin(listed, wanted)]
            by_window = np.isin(code[k], wanted[len(whole) :])
            joined = b"".join(own)
            for i in k[by_window].tolist():
                a, n, c, doc = int(first[i]), int(count[i]), int(context[i]), int(docs[some[row[i]]])
                covered = PrefixHashes(np.frombuffer(joined[a : a + n - 1 + length], dtype=np.uint8))
                at = np.arange(n)
                hashes = mixed(covered.of(at, at + length)).view(np.int64).tolist()
                for j in range(n):
                    put(hashes[j], joined[a + j : a + j + length], doc, c, j)
            k = k[~by_window]
            ends = (first + count - 1 + length)[k].tolist()
            out["key"] += anchor[k].tolist()
            out["content"] += [joined[a:z] for a, z in zip(first[k].tolist(), ends)]
            out["doc"] += docs[some][row[k]].tolist()
            out["context"] += context[k].tolist()
            out["at"] += [0] * len(k)
        return out

    return each_batch(docs, work, "key bigint, content binary, doc bigint, context bigint, at int")


def common_extension(hashes: PrefixHashes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length, up to ``most``, in which the suffixes at a and b agree: a binary search over prefix hashes."""
    low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), most, dtype=np.int64)
    sums, sum_a, sum_b, down_a, down_b = hashes.sums, hashes.sums[a], hashes.sums[b], hashes.down[a], hashes.down[b]
    for _ in range(int(most).bit_length()):
        middle = (low + high + 1) >> 1
        same = (sums[a + middle] - sum_a) * down_a == (sums[b + middle] - sum_b) * down_b
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _heads(data: np.ndarray, starts: np.ndarray, most: int) -> np.ndarray:
    """The first eight bytes of each suffix, ``most`` at the most, as numbers in the order of the bytes."""
    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    heads = np.zeros(len(starts), dtype=np.uint64)
    for i in range(min(8, most)):
        heads |= padded[starts + i].astype(np.uint64) << np.uint64(8 * (7 - i))
    return heads


def suffix_sort(data: np.ndarray, hashes: PrefixHashes, starts: np.ndarray, bucket: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes at ``starts`` by their first ``most`` bytes within each bucket; equal ones keep their order.

    ``bucket`` is sorted. A bottom-up mergesort of all buckets at once: an element's place in the merged pair of runs is
    its own place plus its rank in the other run, found by binary search with suffix comparisons. Eight bytes tell most
    suffixes apart, one hash the equal ones; the others are compared by their common extension.
    """
    n = len(starts)
    begin = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    size = np.diff(np.append(begin, n))
    first, end = np.repeat(begin, size), np.repeat(begin + size, size)
    heads, whole = _heads(data, starts, most), hashes.of(starts, starts + most)
    order, run = np.arange(n), 1
    while run < size.max(initial=0):
        at = np.flatnonzero(end - first > run)
        place = at - first[at]
        mine = place // run
        other = first[at] + (mine ^ 1) * run
        low, stop = other.copy(), np.minimum(other + run, end[at])
        low = np.minimum(low, stop)
        own, left, bottom, high = order[at], mine % 2 == 0, low.copy(), stop
        todo = np.flatnonzero(low < high)
        while len(todo):
            middle = (low[todo] + high[todo]) >> 1
            x, probe = own[todo], order[middle]
            head, head_probe = heads[x], heads[probe]
            before = head_probe < head
            # The left run's elements stand before equal ones of the right run.
            equal = whole[x] == whole[probe]
            before[equal] = ~left[todo[equal]]
            close = np.flatnonzero((head == head_probe) & ~equal)
            if len(close):
                a, b = starts[x[close]], starts[probe[close]]
                same = common_extension(hashes, a, b, most - 1)
                before[close] = data[b + same] < data[a + same]
            low[todo[before]] = middle[before] + 1
            high[todo[~before]] = middle[~before]
            todo = todo[low[todo] < high[todo]]
        target = first[at] + (mine // 2) * 2 * run + place % run + (low - bottom)
        merged = order.copy()
        merged[target] = order[at]
        order, run = merged, 2 * run
    return order


def anchor_places(
    keys: np.ndarray, row: np.ndarray, starts: np.ndarray, hashes: PrefixHashes, length: int
) -> np.ndarray:
    """How far into each window its anchor stands first; 0 for a window that is its own key.

    Equal windows have equal places, so only windows with the same one have to be compared.
    """
    size = max(1, length // 3)
    at = np.arange(len(hashes.sums) - size)
    # A place of the joined contexts that carries an anchor's hash may stand for the anchor of a window around it only
    # if that is the window's key.
    owner = np.zeros(len(at) + 1, dtype=np.int64)
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    owner[starts[first]] = np.diff(np.concatenate(([0], row[first])))
    owner = np.cumsum(owner)[: len(at)]
    marked = at[mixed(hashes.of(at, at + size)).view(np.int64) == keys[owner]]
    nth = np.searchsorted(marked, starts)
    place = marked[np.minimum(nth, max(0, len(marked) - 1))] - starts if len(marked) else np.full(len(starts), -1)
    return np.where((nth < len(marked)) & (place >= 0) & (place <= length - size), place, 0)


def removed_windows(keys: np.ndarray, content: list[bytes], docs: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of the contexts an earlier document's context of the same key holds as well, and where those of each end.

    Rows are sorted by key and document.
    """
    data = np.frombuffer(b"".join(content), dtype=np.uint8)
    size = np.fromiter(map(len, content), dtype=np.int64, count=len(content))
    count = size - length + 1
    row = np.repeat(np.arange(len(content)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    starts = (np.cumsum(size) - size)[row] + nth
    hashes = PrefixHashes(data)
    bucket = _key_numbers(keys)[row] * length + anchor_places(keys, row, starts, hashes, length)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    # A window alone in its bucket equals no other.
    alone = np.diff(np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket)))
    shared = np.repeat(alone, alone) > 1
    flags = np.zeros(len(row), dtype=bool)
    order, bucket = order[shared], bucket[shared]
    if len(order):
        order = order[suffix_sort(data, hashes, starts[order], bucket, length)]
        a, b = starts[order[:-1]], starts[order[1:]]
        same = (bucket[1:] == bucket[:-1]) & (hashes.of(a, a + length) == hashes.of(b, b + length))
        pairs = np.flatnonzero(same)
        span = np.arange(length)
        for at in range(0, len(pairs), 1 << 16):
            some = pairs[at : at + (1 << 16)]
            same[some] = (data[a[some, None] + span] == data[b[some, None] + span]).all(axis=1)
        lead = np.flatnonzero(np.concatenate(([True], ~same)))
        doc = docs[row[order]]
        least = np.repeat(np.minimum.reduceat(doc, lead), np.diff(np.append(lead, len(doc))))
        flags[order] = doc > least
    return flags, np.cumsum(count)


def _key_numbers(keys: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(keys[1:] != keys[:-1])))


def resolve(rows: DataFrame, length: int) -> DataFrame:
    """``doc, context, at, flags``: windows to remove, one byte per window, of contexts that have any."""
    spark = rows.sparkSession
    ordered = rows.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key", "doc")
    schema = T.StructType.fromDDL("doc bigint, context bigint, at int, flags binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)

        def told(found):
            columns = list(zip(*found)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, target)], schema=target)

        def settle(rows: list[tuple]):
            if not rows:
                return told([])
            keys = np.array([r[0] for r in rows], dtype=np.int64)
            docs = np.array([r[2] for r in rows], dtype=np.int64)
            flags, ends = removed_windows(keys, [r[1] for r in rows], docs, length)
            any_ = np.flatnonzero(np.logical_or.reduceat(flags, np.append(0, ends[:-1]))).tolist()
            flags, begins, ends = flags.tobytes(), [0, *ends.tolist()], ends.tolist()
            return told([(*rows[i][2:], flags[begins[i] : ends[i]]) for i in any_])

        held: list[tuple] = []
        seen: dict[bytes, int] = {}
        key, size = None, 0
        for batch in batches:
            copies = []
            for r in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if r[0] != key:
                    if size >= BLOB_BYTES:
                        yield settle(held)
                        held, size = [], 0
                    key, seen = r[0], {}
                # Of equal contents of a key only the earliest document's is sorted.
                first = seen.setdefault(r[1], r[2])
                if first < r[2]:
                    copies.append((r[2], r[3], r[4], b"\x01" * (len(r[1]) - length + 1)))
                elif len(seen) and (not held or held[-1][0] != key or r[1] != held[-1][1] or r[2] != held[-1][2]):
                    held.append(r)
                    size += len(r[1])
            if copies:
                yield told(copies)
        yield settle(held)

    return ordered.mapInArrow(run, schema)


def _spans(texts: list[bytes], whole: Listed, partly: Listed, length: int) -> list[list[tuple[int, int]]]:
    """Maximal stretches [start, end) of bytes to remove, of each text."""
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    removed, flags = whole.values.to_numpy(), partly.values.field("flags").to_pylist()
    looked, shift = (partly.values.field(n).to_numpy() for n in ("context", "at"))
    for some in pieces(texts, whole.size + partly.size > 0):
        own = [texts[i] for i in some]
        row, first, count, _, context = runs(own, length)
        if not len(row):
            continue
        (in_whole, at), (in_part, at_part) = whole.of(some), partly.of(some)
        code, asked = _codes(row, context, np.concatenate([in_whole, in_part]), np.concatenate([removed[at], looked[at_part]]))
        # A place of the joined texts, each with a byte behind it, so that stretches of two texts never touch.
        begin = first + row
        full = np.isin(code, asked[: len(at)])
        edge = np.bincount(begin[full], minlength=sum(map(len, own)) + len(own) + 1)
        edge -= np.bincount(begin[full] + count[full] - 1 + length, minlength=len(edge))
        if len(at_part):
            # Windows of each listed context, at every place where the text holds it.
            flagged = [flags[i] for i in at_part.tolist()]
            size = np.fromiter(map(len, flagged), dtype=np.int64, count=len(flagged))
            windows = np.flatnonzero(np.frombuffer(b"".join(flagged), dtype=bool))
            of = np.searchsorted(np.cumsum(size), windows, side="right")
            windows += shift[at_part][of] - (np.cumsum(size) - size)[of]
            held = np.bincount(of, minlength=len(flagged))
            order = np.argsort(code, kind="stable")
            low, high = (np.searchsorted(code[order], asked[len(at) :], side=x) for x in ("left", "right"))
            each, places = np.repeat(np.arange(len(flagged)), high - low), order[_ranges(low, high - low)]
            start = np.repeat(begin[places], held[each]) + windows[_ranges((np.cumsum(held) - held)[each], held[each])]
            edge += np.bincount(start, minlength=len(edge))
            edge -= np.bincount(start + length, minlength=len(edge))
        gone = np.cumsum(edge[:-1]) > 0
        turn = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
        starts = np.cumsum([0, *(len(t) + 1 for t in own[:-1])])
        of = np.searchsorted(starts, turn[::2], side="right") - 1
        for i, a, z in zip(of.tolist(), (turn[::2] - starts[of]).tolist(), (turn[1::2] - starts[of]).tolist()):
            found[some[i]].append((a, z))
    return found


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the bytes of characters that they only touch."""
    out = []
    for a, z in spans:
        while a < z and text[a] & 0xC0 == 0x80:
            a += 1
        while a < z < len(text) and text[z] & 0xC0 == 0x80:
            z -= 1
        if a < z:
            out.append((a, z))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    cuts = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:z] for a, z in zip(cuts[::2], cuts[1::2]))


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    keep: tuple[str, ...] = (),
    characters: bool = False,
    big: int = BIG,
) -> DataFrame:
    """One row per document: ``id, n_bytes, spans, kept`` and the columns of ``keep``.

    Removed is each byte covered by a string of ``length`` bytes that also starts in a document with a smaller id; all
    strings are those of the input. ``spans`` are the maximal removed stretches [start, end) in bytes, ``kept`` the remaining bytes.
    With ``characters`` a character goes only if all its bytes do, so that ``kept`` is text.

    Null or empty text, or one shorter than ``length``: nothing to remove. Repeats inside one document stay. Rows of one
    id are one document, each with its own text. A null id is larger than every other. Empty input: no rows. Texts are
    shuffled once, to meet what was found about them.
    """
    spark = prepared(docs.sparkSession)
    parts = shuffle_parts(spark)
    own = docs.select(
        comparable_id(id_col).alias("doc"),
        F.col(text_col).alias("text"),
        F.col(id_col).alias("_id"),
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)),
    )
    found = stored(candidates(anchors(own.select("doc", "text"), length), big), "candidates")
    listed = found.repartition(parts, "doc").groupBy("doc")
    listed = listed.agg(
        *(F.collect_list(F.when(F.col("kind") == k, F.col("context"))).alias(n) for n, k in (("whole", WHOLE), ("look", CONTEXT), ("split", WINDOWS)))
    )
    texts = own.repartition(parts, "doc")
    unsure = texts.join(listed.filter((F.size("look") > 0) | (F.size("split") > 0)), "doc")
    partly = resolve(contexts(unsure.select("doc", "text", "look", "split"), length), length)
    partly = partly.repartition(parts, "doc").groupBy("doc").agg(F.collect_list(F.struct("context", "at", "flags")).alias("partly"))
    met = texts.join(listed.select("doc", "whole"), "doc", "left").join(partly, "doc", "left")

    def cut(batch) -> dict:
        texts = texts_of(batch)
        spans = _spans(texts, Listed(batch.column("whole")), Listed(batch.column("partly")), length)
        if characters:
            spans = [whole_characters(t, s) for t, s in zip(texts, spans)]
        return {id_col: batch.column("_id")} | {c: batch.column(f"_{i}") for i, c in enumerate(keep)} | {
            "n_bytes": [len(t) for t in texts],
            "spans": [[{"start": a, "end": z} for a, z in s] for s in spans],
            "kept": [without(t, s) for t, s in zip(texts, spans)],
        }

    fields = [docs.schema[c] for c in (id_col, *keep)]
    result = T.StructType.fromDDL("n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary")
    return each_batch(met, cut, T.StructType([*fields, *result.fields]))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substring(x, 2 * i + 1, 100) AS win
      FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM d WHERE len(x) >= 100)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY win) AS first FROM w) WHERE doc_id > first),
edges AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM hit),
marked AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY i) AS k FROM edges),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS z FROM marked GROUP BY doc_id, k),
cuts AS (SELECT doc_id, list(a ORDER BY a) AS a, list(z ORDER BY a) AS z, sum(z - a) AS removed FROM spans GROUP BY doc_id)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(len(a), 0) AS BIGINT) AS n_spans,
       CASE WHEN a IS NULL THEN sha256(unhex(x)) ELSE sha256(unhex(array_to_string(list_transform(
         range(0, len(a) + 1), lambda k: substring(x, 2 * (CASE WHEN k = 0 THEN 0 ELSE z[k] END) + 1,
           2 * ((CASE WHEN k = len(a) THEN len(x) // 2 ELSE a[k + 1] END) - (CASE WHEN k = 0 THEN 0 ELSE z[k] END)))), ''))) END
         AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)
"""
