"""The prefix trie of conversations: which conversations begin alike, and what storing a shared beginning once saves.

1. Distinct turns are numbered along their digests; the number, eight bytes big-endian, stands for the turn. A
   conversation is the byte string of its numbers. Equal strings fold into one, with their count and smallest id.
2. The strings are range-sorted over all tasks. Each task puts stretches of its share into an adaptive radix tree and
   walks it: at depths that are a multiple of eight bytes, also inside a compressed path, stands a node of the trie.
3. Everything a node reports is a sum or minimum over stretches. What must count once, the bytes of a node and a leaf,
   is counted by the stretch where the node comes first in the order; for that a task knows the last string before its
   share and the first one after it. So no subtree has to lie in one task, however many conversations begin alike.
4. Nodes meet by the digest of their path, then their parents and the conversations that end there.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ordering import numbered
from tidemark.llm.common import prepared, shuffle_parts, stored
from tidemark.session import checkpointed

WIDTH = 8
# Strings of a stretch, and their bytes: what one tree holds.
STRETCH, STRETCH_BYTES = 20_000, 8 << 20
# Text of ids that a row carries to the digest of a node.
ENDS_BYTES = 1 << 16


class Few:
    """Up to 4 or 16 children beside their bytes, in order."""

    __slots__ = ("room", "bytes", "kids")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.kids = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def full(self) -> bool:
        return len(self.kids) == self.room

    def put(self, byte: int, kid) -> None:
        at = self.bytes.find(byte)
        if at >= 0:
            self.kids[at] = kid
            return
        at = sum(b < byte for b in self.bytes)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)

    def all(self) -> list:
        return self.kids

    def larger(self):
        out = Few(16) if self.room == 4 else Indexed()
        for b, k in zip(self.bytes, self.kids):
            out.put(b, k)
        return out


class Indexed:
    """Up to 48 children behind an index of 256 bytes."""

    __slots__ = ("index", "kids")

    def __init__(self):
        self.index, self.kids = bytearray(256), []

    def get(self, byte: int):
        at = self.index[byte]
        return self.kids[at - 1] if at else None

    def full(self) -> bool:
        return len(self.kids) == 48

    def put(self, byte: int, kid) -> None:
        if self.index[byte]:
            self.kids[self.index[byte] - 1] = kid
        else:
            self.kids.append(kid)
            self.index[byte] = len(self.kids)

    def all(self) -> list:
        return [self.kids[at - 1] for at in self.index if at]

    def larger(self):
        out = Direct()
        for byte, at in enumerate(self.index):
            if at:
                out.put(byte, self.kids[at - 1])
        return out


class Direct:
    """A place for each byte."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def full(self) -> bool:
        return False

    def put(self, byte: int, kid) -> None:
        self.kids[byte] = kid

    def all(self) -> list:
        return [k for k in self.kids if k is not None]


class Branch:
    """A compressed path, the string that ends after it, and what follows it by the next byte."""

    __slots__ = ("path", "ends", "below")

    def __init__(self, path: bytes, ends: int | None = None):
        self.path, self.ends, self.below = path, ends, Few()

    def put(self, byte: int, kid) -> None:
        if self.below.full() and self.below.get(byte) is None:
            self.below = self.below.larger()
        self.below.put(byte, kid)


class RadixTree:
    """Adaptive radix tree over byte strings; each distinct string carries a number."""

    def __init__(self):
        self.root = Branch(b"")

    def insert(self, key: bytes, number: int) -> None:
        above, node, at = None, self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                shared = len(os.path.commonprefix([path, key[at : at + len(path)]]))
                top = Branch(path[:shared])
                node.path = path[shared + 1 :]
                top.put(path[shared], node)
                if above is None:
                    self.root = top
                else:
                    above.put(key[at - 1], top)
                node = top
            at += len(node.path)
            if at == len(key):
                node.ends = number
                return
            kid = node.below.get(key[at])
            if kid is None:
                node.put(key[at], Branch(key[at + 1 :], number))
                return
            above, node, at = node, kid, at + 1


def shared_turns(a: bytes | None, b: bytes | None) -> int:
    """Turns that two strings begin with alike; -1 if one is missing."""
    if a is None or b is None:
        return -1
    return len(os.path.commonprefix([a, b])) // WIDTH


FIELDS = "node binary, parent binary, depth bigint, turn_id bigint, conv bigint, n bigint, leaves bigint, saved bigint"


def nodes_of(keys: list[bytes], sizes: list, n: list[int], convs: list[int], before: bytes | None, after: bytes | None):
    """Rows of FIELDS for the trie nodes of one stretch of strings in order.

    ``before`` and ``after`` are the strings next to the stretch. ``n`` and ``leaves`` are those of the stretch; ``saved`` counts a
    node's bytes negatively where the stretch is the first to hold it, so that sums over stretches are whole.
    """
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    first, known = keys[0], shared_turns(before, keys[0])
    goes_on = after is not None and after.startswith(keys[-1])
    # Branches from the top: [branch, index of the one above, first and last depth in turns, digests, a string below it].
    order: list[list] = []
    stack = [(tree.root, -1, -1, hashlib.md5())]
    while stack:
        branch, above, end, state = stack.pop()
        # Bytes up to the branching byte of the branch above, then this branch's own path.
        own = end + 1 + len(branch.path)
        order.append([branch, above, end // WIDTH + 1 if end >= 0 else 0, own // WIDTH, None, None])
        stack += [(k, len(order) - 1, own, state) for k in reversed(branch.below.all())]
    # A string below each branch, and sums from below.
    total, least, leaf, saved = [[0] * len(order) for _ in range(4)]
    for i in range(len(order) - 1, -1, -1):
        branch, above, low, high, _, some = order[i]
        if branch.ends is not None:
            k = branch.ends
            total[i] += n[k]
            least[i] = convs[k] if some is None else min(least[i], convs[k])
            if some is None:
                leaf[i] = 0 if k == len(keys) - 1 and goes_on else 1
            order[i][5] = some = k
        here = []
        key, size = keys[some], sizes[some]
        for depth in range(high, low - 1, -1):
            if depth:
                held = depth <= known and key.startswith(first[: depth * WIDTH])
                saved[i] += (total[i] - (not held)) * size[depth - 1]
            here.append((depth, total[i], least[i], leaf[i], saved[i]))
        order[i][4] = here
        if above >= 0:
            seen = order[above][5] is not None
            least[above] = min(least[above], least[i]) if seen else least[i]
            total[above] += total[i]
            leaf[above] += leaf[i]
            saved[above] += saved[i]
            order[above][5] = some
    # Digests of paths, from the top.
    states: list = [None] * len(order)
    for i, (_, above, low, high, here, some) in enumerate(order):
        state, parent = (states[above][0].copy(), states[above][1]) if above >= 0 else (hashlib.md5(), None)
        key = keys[some]
        for depth, members, conv, leaves, bytes_ in reversed(here):
            turn = None
            if depth:
                step = key[(depth - 1) * WIDTH : depth * WIDTH]
                state.update(step)
                turn = int.from_bytes(step, "big")
            node = state.digest()
            yield node, parent, depth, turn, conv, members, leaves, bytes_
            parent = node
        states[i] = (state, parent)


def sequences(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str):
    """``conv, ids, sizes`` of each conversation, and ``turn_id, role, text`` of each distinct turn.

    Both arrays are in the order of turns, null first, equal ones by id. ``sizes`` are the UTF-8 bytes of the texts.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    written = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.md5(written.cast("binary"))).alias("digest"),
    ).filter("conv IS NOT NULL")
    ids = numbered(turns.select("digest").distinct(), [F.col("digest")], "turn_id")
    known = turns.select("conv", "turn", "digest", F.octet_length("text").cast("bigint").alias("size")).join(ids, "digest")
    place = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"), F.col("turn_id").alias("id"), "size")
    ordered = known.groupBy("conv").agg(F.sort_array(F.collect_list(place)).alias("t"))
    texts = turns.groupBy("digest").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    return (
        ordered.select("conv", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes")),
        texts.join(ids, "digest").select("turn_id", "role", "text"),
    )


def _sorted_strings(strings: DataFrame) -> DataFrame:
    """Distinct strings in order over all tasks, each row with the strings next to its task's share.

    Checkpointed, because shares depend on sampled bounds. The table of borders has two strings for each task.
    """
    spark = strings.sparkSession
    ranged = strings.repartitionByRange(shuffle_parts(spark), "key").sortWithinPartitions("key")
    rows = checkpointed(ranged.withColumn("part", F.spark_partition_id()))
    along = Window.orderBy("part")
    borders = (
        rows.groupBy("part")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .select("part", F.lag("high").over(along).alias("before"), F.lead("low").over(along).alias("after"))
    )
    return rows.join(F.broadcast(borders), "part")


def _grown(rows: DataFrame) -> DataFrame:
    schema = T.StructType.fromDDL(FIELDS)
    names = ("key", "sizes", "n", "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        held: list[tuple] = []
        weight, before, after = 0, None, None

        def emit(next_key):
            keys, sizes, n, convs = zip(*held)
            found = list(zip(*nodes_of(list(keys), sizes, n, convs, before, next_key)))
            for at in range(0, len(found[0]), 50_000):
                arrays = [pa.array(c[at : at + 50_000], type=f.type) for c, f in zip(found, target)]
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

        started = False
        for batch in batches:
            if not batch.num_rows:
                continue
            if not started:
                started, before, after = True, batch.column("before")[0].as_py(), batch.column("after")[0].as_py()
            for row in zip(*(batch.column(c).to_pylist() for c in names)):
                if len(held) >= STRETCH or weight >= STRETCH_BYTES:
                    yield from emit(row[0])
                    before, held, weight = held[-1][0], [], 0
                held.append(row)
                weight += len(row[0])
        if held:
            yield from emit(after)

    return rows.mapInArrow(run, schema)


def _runs(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple]:
    yield from zip(*(batch.column(c).to_pylist() for c in names))


def ends_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256``: digest of the comma-joined ids that end at each node, in numerical order.

    Ids are written to pieces of text by range over all tasks; only the pieces of a node meet, and are digested one after
    the other.
    """
    parts = shuffle_parts(ends.sparkSession)
    ranged = ends.repartitionByRange(parts, "node", "conv").sortWithinPartitions("node", "conv")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, firsts, texts, size = [], [], [], 0
            for node, conv in _runs(batch, ("node", "conv")):
                if not nodes or nodes[-1] != node or size > ENDS_BYTES:
                    nodes.append(node)
                    firsts.append(conv)
                    texts.append([])
                    size = 0
                texts[-1].append(str(conv))
                size += len(texts[-1][-1]) + 1
            if nodes:
                joined = [",".join(t) for t in texts]
                columns = [pa.array(nodes, pa.binary()), pa.array(firsts, pa.int64()), pa.array(joined, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "first", "ids"])

    pieces = ranged.mapInArrow(write, "node binary, first bigint, ids string")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            nodes, digests = [], []
            for node, ids in _runs(batch, ("node", "ids")):
                if node == last:
                    state.update(b"," + ids.encode())
                    continue
                if last is not None:
                    nodes.append(last)
                    digests.append(state.hexdigest())
                last, state = node, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    together = pieces.repartition(parts, "node").sortWithinPartitions("node", "first")
    return together.mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    rebuild: Callable[[DataFrame], DataFrame] | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The trie of conversations, and its turns.

    First frame, one row per distinct sequence of the first ``depth`` turns of a conversation, from the root on: ``node,
    parent`` (digests of the sequences), ``turn_id`` (its last turn; null at the root), ``depth, conv_id`` (smallest member),
    ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``. ``saved_tokens`` sums, over the subtree, the
    bytes of a node's last text times its members but one. Second frame: ``turn_id, role, text``.

    ``rebuild`` may change the sequences before they are put together: it takes and returns ``conv, ids, sizes``, one row per
    conversation; one without turns is a member of the root.

    Null role or text: empty. Null turn: before all others; equal turn numbers stand in the order of their turns' digests,
    a repeated row is a turn of its own. Null conversation ids are no conversation and left out; ids are integers. A
    conversation's turn numbers are held in one row, like a text. Empty input: no rows, not even a root.
    """
    prepared(conversations.sparkSession)
    found, turns = sequences(conversations, conv_col, turn_col, role_col, text_col)
    if rebuild:
        found = rebuild(stored(found, "trie-sequences"))
    byte_string = F.unhex(F.array_join(F.transform("ids", lambda i: F.lpad(F.hex(i), 2 * WIDTH, "0")), ""))
    whole = stored(found.select("conv", byte_string.alias("key"), "sizes"), "trie-strings")
    strings = whole.groupBy("key").agg(
        F.any_value("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")
    )
    partial = _grown(_sorted_strings(strings).select("key", "sizes", "n", "conv", "before", "after"))
    nodes = stored(
        partial.groupBy("node", "parent", "depth", "turn_id").agg(
            F.min("conv").alias("conv_id"),
            F.sum("n").alias("n_convs"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("saved").alias("saved_tokens"),
        ),
        "trie-nodes",
    )
    ends = ends_digests(whole.select(F.unhex(F.md5("key")).alias("node"), "conv"))
    kids = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(above, "parent", "left").join(kids, "node", "left").join(ends, "node", "left")
    return (
        out.select(
            "node",
            "parent",
            "turn_id",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        ),
        turns,
    )


def head_of_fifth(sequences: DataFrame) -> DataFrame:
    """The rebuilt conversations of the query: the first h turns of conversation c - c % 5, then c's own after its first
    h; h is the CRC-32 of c in decimal, modulo 9.
    """
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 9).cast("int")
    head = sequences.select(F.col("conv").alias("_c"), F.col("ids").alias("_ids"), F.col("sizes").alias("_sizes"))
    met = sequences.withColumns({"_c": F.col("conv") - F.col("conv") % 5, "_h": h}).join(head, "_c", "left")

    def spliced(own: str, other: str):
        none = F.array().cast("array<bigint>")
        own_rest = F.slice(own, F.col("_h") + 1, F.greatest(F.size(own) - F.col("_h"), F.lit(0)))
        return F.concat(F.slice(F.coalesce(other, none), F.lit(1), F.col("_h")), own_rest)

    return met.select("conv", spliced("ids", "_ids").alias("ids"), spliced("sizes", "_sizes").alias("sizes"))


SQL = """
WITH turns AS (
    SELECT conv_id AS c, turn, coalesce(text, '') AS t, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT c, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(strlen(t) ORDER BY turn NULLS FIRST, k) AS bs,
        xor(list_reduce(
            flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]))::BIGINT[],
            lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END,
            4294967295::BIGINT
        ), 4294967295) % 9 AS h
    FROM turns GROUP BY c
), built AS (
    SELECT o.c, list_concat(coalesce(p.ks, [])[1:o.h], o.ks[o.h + 1:]) AS ks, list_concat(coalesce(p.bs, [])[1:o.h], o.bs[o.h + 1:]) AS bs
    FROM own o LEFT JOIN own p ON p.c = o.c - o.c % 5
), nodes AS (
    SELECT array_to_string(ks[1:d], ',') AS p, d, any_value(ks[1:d]) AS ks, any_value(CASE WHEN d = 0 THEN 0 ELSE bs[d] END) AS size,
        min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c, ',' ORDER BY c) FILTER (WHERE len(ks) = d), '')) AS ends
    FROM built, unnest(range(0, len(ks) + 1)) AS u(d) GROUP BY p, d
), kids AS (
    SELECT array_to_string(ks[1:d - 1], ',') AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), sums AS (
    SELECT array_to_string(n.ks[1:k], ',') AS p, count(*) FILTER (WHERE kids.n IS NULL) AS leaves, sum((n.n_convs - 1) * n.size) AS saved
    FROM nodes n LEFT JOIN kids ON kids.p = n.p, unnest(range(0, n.d + 1)) AS u(k) GROUP BY 1
)
SELECT n.conv_id, n.d AS depth, above.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children,
    sums.leaves AS n_leaves, sums.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums ON sums.p = n.p LEFT JOIN kids ON kids.p = n.p
LEFT JOIN nodes above ON n.d > 0 AND above.p = array_to_string(n.ks[1:n.d - 1], ',')
"""
