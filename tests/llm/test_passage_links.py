"""Links of near passages next to all pairs: chains of drifting texts, and passages of which an earlier text holds a part."""

import random

from tests.llm.helpers import docs_frame, prose
from tidemark.llm import passages


def grams(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def similarity(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b)


def edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(5, len(words) - 5, 6), n):
        words[i] = f"x{rng.randrange(10**9)}"
    return words


def test_every_link_of_drifting_texts_is_found(spark):
    rng = random.Random(31)
    texts = []
    for _ in range(25):
        chain = [prose(rng, 200, 10**6).split()]
        for _ in range(3):
            chain.append(edited(rng, chain[-1], 3))
        texts += chain + [chain[1]]
    rows = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    out = {r["doc_id"]: r for r in passages.near_passages(docs_frame(spark, rows)).collect()}
    near = [(j, i) for i in range(len(texts)) for j in range(i) if similarity(texts[i], texts[j]) >= 0.8]
    # A copy stands for its text: links are those between different texts, and of a copy to its earliest holder.
    first = {i: min(j for j in range(i + 1) if texts[j] == texts[i]) for i in range(len(texts))}
    near = [(j, i) for j, i in near if first[j] == j and (first[i] == i or first[i] == j)]
    linked = {(p["other"], d) for d, r in out.items() for p in r["passages"]}
    assert len(near) >= 100 and sum(x in linked for x in near) >= 0.98 * len(near)
    assert sum(out[j]["class_id"] == out[i]["class_id"] for j, i in near) >= 0.98 * len(near)


def test_an_earlier_holder_of_a_part_hides_no_link(spark):
    rng = random.Random(32)
    rows, n = [], 20
    for g in range(n):
        shared = prose(rng, 150, 10**6).split()
        for k, middle in enumerate((shared[:70], shared, edited(rng, shared, 2), shared)):
            text = " ".join([prose(rng, 60, 10**6), *middle, prose(rng, 60, 10**6)])
            rows.append((4 * g + k, text, "en", "s"))
    out = {r["doc_id"]: r for r in passages.near_passages(docs_frame(spark, rows)).collect()}
    whole = {(d, p["other"]) for d, r in out.items() for p in r["passages"] if p["end"] - p["start"] >= 130}
    assert sum((4 * g + 3, 4 * g + 1) in whole for g in range(n)) >= n - 1
    linked = {(d, p["other"]) for d, r in out.items() for p in r["passages"]}
    assert sum((4 * g + 2, 4 * g + 1) in linked for g in range(n)) >= n - 1
    assert all(len({out[4 * g + k]["class_id"] for k in range(4)}) == 1 for g in range(n))


def test_blocks_of_windows_meet_each_other(spark, monkeypatch):
    rng = random.Random(33)
    base = prose(rng, 200, 10**6).split()
    rows = [(i, " ".join(edited(rng, base, 1)), "en", "s") for i in range(24)]
    whole = sorted(map(repr, passages.near_passages(docs_frame(spark, rows)).collect()))
    monkeypatch.setattr(passages, "BLOCK", 5)
    assert sorted(map(repr, passages.near_passages(docs_frame(spark, rows)).collect())) == whole


def test_a_run_of_matches_holds_the_same_seed():
    rng = random.Random(34)
    shared = prose(rng, passages.RUN + 4, 10**6).split()
    found = []
    for n in (40, 70):
        words = [w.encode() for w in prose(rng, n, 10**6).split() + shared + prose(rng, n, 10**6).split()]
        places, values = passages.seeds(words, passages.RUN, passages.SEED)
        found.append({v for p, v in zip(places.tolist(), values.tolist()) if n <= p <= n + passages.RUN - passages.SEED})
    assert found[0] & found[1]


def test_a_stock_phrase_brings_only_similar_windows_together(spark, monkeypatch):
    rng = random.Random(35)
    monkeypatch.setattr(passages, "BLOCK", 4)
    phrase, n = prose(rng, 12, 10**6).split(), 150
    rows = [(i, " ".join([*phrase, *prose(rng, 150, 10**6).split()]), "en", "s") for i in range(n)]
    for i in range(0, 20, 2):
        rows[i + 1] = (i + 1, " ".join(edited(rng, rows[i][1].split(), 1)), "en", "s")
    docs = docs_frame(spark, rows).selectExpr("doc_id AS doc", "text")
    found = passages.windows(docs, 46, passages.HASHES)
    met = passages.meetings(docs, found, passages.HASHES, passages.RUN, passages.SEED).select("a", "b").distinct().collect()
    out = {r["doc_id"]: r for r in passages.near_passages(docs_frame(spark, rows)).collect()}
    assert all(out[i + 1]["class_id"] == i for i in range(0, 20, 2))
    assert len(met) < n


def test_a_word_repeated_over_a_passage_is_linked_wherever_it_stands():
    import numpy as np

    rng = random.Random(36)
    a = [b"w"] * 80
    b = [w.encode() for w in ["w"] * 10 + prose(rng, 30, 10**6).split() + ["w"] * 70 + prose(rng, 30, 10**6).split() + ["w"] * 9]
    a, b = (passages.shingle_hashes(x)[: len(x) - 4] for x in (a, b))
    assert any((first, last) == (40, 105) for _, _, first, last, _ in passages.common_passages(a, np.array(b), 46, 0.8))
