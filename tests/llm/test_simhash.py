"""Links of fingerprints next to all pairs, and which document of a group stays."""

import random

import pytest

from tests.llm.helpers import docs_frame, prose
from tidemark.llm import simhash


def signed(p):
    return p - 2**64 if p >> 63 else p


def around(seed, n=40):
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(n)]
    for p in prints[: n * 3 // 4]:
        for k in (1, 2, 2, 3):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), k)))
    # Many that share one half with a given one, near it and not.
    half = rng.getrandbits(32) << 32
    prints += [half | rng.getrandbits(4) for _ in range(10)] + [half | rng.getrandbits(32) for _ in range(20)]
    return sorted({signed(p) for p in prints})


def near(prints):
    return {(a, b) for a in prints for b in prints if a > b and ((a ^ b) % 2**64).bit_count() <= 2}


def frame(spark, prints):
    return spark.createDataFrame([(p,) for p in prints], "print bigint")


def classes(pairs, nodes):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in nodes}


def test_links_at_two_bits_and_not_at_three(spark):
    prints = around(9)
    edges = {(r["a"], r["b"]) for r in simhash.links(frame(spark, prints)).collect()}
    assert edges == near(prints)


@pytest.mark.parametrize("crowded", [0, 1, 3])
def test_crowded_entries_lose_no_link(spark, crowded):
    prints = around(10)
    edges = {(r["a"], r["b"]) for r in simhash.links(frame(spark, prints), crowded).collect()}
    assert edges <= near(prints)
    assert classes(edges, prints) == classes(near(prints), prints)


def test_tables_fetch_candidates_that_the_distance_rejects(spark):
    base = 0x1234567800000000
    prints = [base, base | 0xFFFF, base ^ 1, (base ^ (1 << 40)) | 0xF0]
    pairs, rest = simhash.looked_up(frame(spark, prints), 64)
    fetched = {(r["a"], r["b"]) for r in pairs.collect()}
    assert rest.count() == 0 and (base | 0xFFFF, base) in fetched and near(prints) < fetched
    assert {(r["a"], r["b"]) for r in simhash.links(frame(spark, prints)).collect()} == near(prints)


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(3)
    text, other, third, own = (prose(rng, 80) for _ in range(4))
    rows = [
        (1, text, "en", "a"),
        (None, text, "en", "a"),
        (None, other, "en", "b"),
        (None, other, "en", "a"),
        (2, third, "en", "a"),
        (2, text, "en", "c"),
        (5, third, "en", "a"),
        (None, own, "en", "a"),
        (7, None, "en", "a"),
        (8, "", "en", "a"),
        (9, " \n", "en", "b"),
    ]
    kept = sorted((repr(r["doc_id"]), r["text"], r["source"]) for r in simhash.first_of_each(docs_frame(spark, rows, clashing=True)).collect())
    expected = [("1", text, "a"), ("None", other, "a"), ("2", third, "a"), ("None", own, "a"), ("7", None, "a")]
    assert kept == sorted(expected)
    out = simhash.near_duplicates(docs_frame(spark, rows)).collect()
    assert sorted(repr((r["doc_id"], r["component_id"])) for r in out) == sorted(
        map(repr, [(1, 1), (None, 1), (None, None), (None, None), (2, 2), (2, 1), (5, 2), (None, None), (7, 7), (8, 7), (9, 7)])
    )


def test_very_many_null_ids(spark):
    rng = random.Random(4)
    text = prose(rng, 60)
    rows = [(None, text, "en", "a")] * 3000 + [(None, prose(rng, 60), "en", "a") for _ in range(200)]
    kept = [r["text"] for r in simhash.first_of_each(docs_frame(spark, rows)).collect()]
    assert len(kept) == len(set(kept)) == 201
