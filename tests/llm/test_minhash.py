"""Near-duplicates by HyperMinHash next to all pairs of sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_rows, docs_frame, prose
from tidemark.llm import minhash


def shingles(text, size=4):
    lower = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    words = lower.split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows):
    """Classes by comparing every two sets."""
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= 80 * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    ids = [2**63 - 1 if d is None else d for d, *_ in rows]
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), 2**63), ids[i])
    out = []
    for i, (d, *_) in enumerate(rows):
        c = least[find(i)]
        c = None if c == 2**63 - 1 else c
        out.append((d, len(sets[i]), c, d == c))
    return sorted(map(repr, out))


def near_corpus(seed, n=240):
    """Copies, texts edited a little more each time (drift), and edits whose similarity is about 0.8."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3 or not rows:
            text = prose(rng, rng.choice([3, 4, 5, 6, 9, 20, 60, 150, 400]), 5000)
        else:
            text = rng.choice(rows[-40:])[1]
            words = text.split(" ")
            if kind < 0.4:
                text = text.upper() if rng.random() < 0.5 else text.replace(" ", "\n\t")
            elif kind < 0.8:
                edits = max(1, int(len(words) * rng.choice([0.01, 0.022, 0.027, 0.03, 0.05])))
                for _ in range(edits):
                    words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
                text = " ".join(words)
            else:
                cut = int(len(words) * rng.choice([0.8, 0.81, 0.79, 0.9]))
                text = " ".join(words[:cut])
        rows.append((i * 13 % 997, text, "en", "a"))
    return rows


def result(spark, rows, **how):
    out = minhash.near_duplicates(docs_frame(spark, rows, clashing=True), **how).collect()
    return sorted(repr(tuple(r)) for r in out)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = near_corpus(seed)
    expected = brute(rows)
    assert len({r.split(", ")[2] for r in expected}) < len(rows) - 40
    assert result(spark, rows) == expected


def test_hot_group_of_near_copies(spark, monkeypatch):
    """A third of the texts are edits of one, with classes that meet but are not linked; small blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(4)
    base = prose(rng, 200, 5000).split(" ")
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([1, 3, 8, 12])):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "a"))
    rows += [(1000 + i, prose(rng, 90, 5000), "en", "b") for i in range(150)]
    expected = brute(rows)
    assert len({r.split(", ")[2] for r in expected}) > 155
    assert result(spark, rows) == expected


def test_awkward_and_empty(spark):
    rows = awkward_rows() + [(None, "w1 w2 w3", "en", "a"), (None, "own words of none", None, None)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_long_shingles_and_stretches(spark, monkeypatch):
    texts = [prose(random.Random(i), 300).encode() for i in range(4)] + [b"", b"x" * 5000 + b" a b c d e"]
    whole = minhash.shingle_hashes(texts, 4)
    monkeypatch.setattr(minhash, "STRETCH_BYTES", 6000)
    parts = minhash.shingle_hashes(texts, 4)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_registers_keep_the_smallest_hash_of_each_bucket():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 5000, dtype=np.uint64))
    hashes = np.unique(np.append(hashes, [np.uint64(x) for x in (0, 1, (1 << 57) - 1, 2**64 - 1)]))
    found = minhash.registers(hashes, np.zeros(len(hashes), dtype=np.int64), 1)[0].tolist()
    expected = [0] * minhash.REGISTERS
    for bucket in range(minhash.REGISTERS):
        own = [x & ((1 << 57) - 1) for x in hashes.tolist() if x >> 57 == bucket]
        if own:
            bits = bin(min(own))[2:] if min(own) else ""
            zeros = min(57 - len(bits), 57 - minhash.MANTISSA)
            after = bits[1:] if len(bits) > minhash.MANTISSA else bits
            mantissa = int(after[: minhash.MANTISSA], 2) if after else 0
            expected[bucket] = (zeros << minhash.MANTISSA) + mantissa + 1
    assert found == expected


def test_collision_chance_is_that_of_unrelated_sets(spark):
    """Measured with a short mantissa, where collisions are frequent enough to be counted."""
    rng = np.random.default_rng(3)
    equal = 0
    cells = 400
    for _ in range(cells):
        a, b = (np.unique(rng.integers(0, 2**64, 3000, dtype=np.uint64)) for _ in range(2))
        ra, rb = (minhash.registers(h, np.zeros(len(h), dtype=np.int64), 1)[0] for h in (a, b))
        cut = minhash.MANTISSA - 4
        equal += int((((ra - 1) >> cut) == ((rb - 1) >> cut)).sum())
    df = spark.createDataFrame([(3000, 3000)], "a bigint, b bigint")
    chance = df.select(minhash.collision_chance(F.col("a"), F.col("b"))).first()[0] * 2**14
    assert abs(equal / (cells * minhash.REGISTERS) - chance) < 0.15 * chance
