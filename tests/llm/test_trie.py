"""The prefix trie next to plain dictionaries of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
QUERY = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute(rows, fifth=True):
    """Rows in the order of QUERY, one dictionary entry per prefix."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, digest(role, text), (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    built = own
    if fifth:
        built = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, ms in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(ms) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(built[c]) == len(p))
        above = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(ms), len(p), above, len(ms), kids[p], leaves[p], saved[p], sha))
    return sorted(map(repr, out))


def talks(seed, n=300):
    rng = random.Random(seed)
    texts = ["", "hi", "é", "yes", "no", "日本", "x" * 500, "a b"]
    rows = []
    for c in range(n):
        kind = rng.random()
        if kind < 0.3:
            rows += [(c, 0, "user", "hi"), (c, 1, "assistant", "yes")]
            continue
        for t in range(rng.randint(1, 11)):
            text = rng.choice(texts) if rng.random() < 0.8 else f"own {c} {t}"
            rows.append((c, t, rng.choice(["user", "assistant", None]), text))
    rng.shuffle(rows)
    return rows


def result(spark, rows, rebuild=trie.head_of_fifth):
    nodes, turns = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), rebuild)
    return nodes, turns, sorted(repr(tuple(r)) for r in nodes.select(*QUERY).collect())


@pytest.mark.parametrize("stretch", [trie.STRETCH, 7])
def test_against_dictionaries(spark, monkeypatch, stretch):
    monkeypatch.setattr(trie, "STRETCH", stretch)
    rows = talks(stretch)
    nodes, turns, out = result(spark, rows)
    assert out == brute(rows)
    nodes, turns, out = result(spark, rows, None)
    assert out == brute(rows, fifth=False)
    known = {r["turn_id"] for r in turns.collect()}
    assert {r["turn_id"] for r in nodes.collect()} - {None} == known


def test_awkward(spark):
    rows = talks(5, 40) + [
        (None, 0, "user", "lost"),
        (100, None, None, None),
        (100, None, "user", "b"),
        (100, 3, "user", "same"),
        (100, 3, "user", "same"),
        (100, 3, "assistant", "same"),
        (-3, 0, "user", "negative"),
        (7, 99, "user", "late" * 50_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "sizes", "n", "conv", "part", "node", "ids"):
        df = df.selectExpr("*", f"'x' AS {name}")
    out = trie.prefix_trie(df)[0].select(*QUERY).collect()
    assert sorted(repr(tuple(r)) for r in out) == brute(rows, fifth=False)


def test_turnless_and_empty(spark):
    # Conversations of one turn whose h is above 0 and whose head is absent are without turns.
    rows = [(c, 0, "user", "x") for c in (11, 12, 13, 14)]
    assert any(zlib.crc32(str(c).encode()) % 9 for c, *_ in rows)
    assert result(spark, rows)[2] == brute(rows)
    assert result(spark, [])[2] == []


def test_long_conversation(spark):
    rows = [(c, t, "user", f"turn {t}" if t < 400 or c == 1 else f"{c}") for c in (1, 2, 3) for t in range(900 + c)]
    assert result(spark, rows, None)[2] == brute(rows, fifth=False)


def test_tree_finds_every_string_in_every_layout():
    rng = random.Random(1)
    keys = {bytes(rng.choice([0, 0, 0, 7, rng.randrange(256)]) for _ in range(8 * rng.randint(0, 4))) for _ in range(3000)}
    keys |= {bytes([0, 0, i, 0, 0, 0, 0, j]) for i in range(60) for j in range(20)}
    tree = trie.RadixTree()
    for i, k in enumerate(rng.sample(sorted(keys), len(keys))):
        tree.insert(k, i)
    found, layouts, stack = [], set(), [(tree.root, b"")]

    def children(below):
        if isinstance(below, trie.Few):
            return list(zip(below.bytes, below.kids))
        if isinstance(below, trie.Indexed):
            return [(b, below.kids[at - 1]) for b, at in enumerate(below.index) if at]
        return [(b, k) for b, k in enumerate(below.kids) if k is not None]

    while stack:
        node, at = stack.pop()
        at += node.path
        layouts.add((type(node.below).__name__, getattr(node.below, "room", 0)))
        if node.ends is not None:
            found.append(at)
        stack += [(k, at + bytes([b])) for b, k in children(node.below)]
        assert [k for _, k in children(node.below)] == node.below.all()
    assert sorted(found) == sorted(keys) and len(layouts) == 4
