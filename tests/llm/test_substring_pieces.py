"""Texts are hashed together, not one by one; what is found about each stays what it is by itself."""

import random

import numpy as np
import pyarrow as pa

from tests.llm.helpers import docs_frame, prose
from tidemark.llm import substrings


def texts():
    rng = random.Random(12)
    some = [b"", b"short", b"x" * 400, b"ab" * 150, "日本語 ".encode() * 30]
    some += [prose(rng, rng.randint(0, 60), 9).encode() for _ in range(60)]
    return some + [b"", some[-1], some[-1][7:]]


def test_runs_of_joined_texts_are_those_of_each():
    for length in (1, 2, 5, 50):
        size = max(1, length // 3)
        row, first, count, anchor, context = substrings.runs(texts(), length)
        at, seen = 0, {}
        for i, t in enumerate(texts()):
            own = np.flatnonzero(row == i)
            # The windows of a text are those of its runs, each once and in order.
            windows = [first[k] - at + j for k in own.tolist() for j in range(int(count[k]))]
            assert windows == list(range(max(0, len(t) - length + 1)))
            assert (count[own] <= length - size + 1).all()
            for k in own.tolist():
                begin = int(first[k]) - at
                covered = t[begin : begin + int(count[k]) - 1 + length]
                assert seen.setdefault(covered, (anchor[k], context[k])) == (anchor[k], context[k])
            at += len(t)
        assert len({c for _, c in seen.values()}) == len(seen)
    assert all(len(x) == 0 for x in substrings.runs([b"", b"abc"], 50))


def test_a_batch_of_short_texts_is_hashed_in_few_pieces(monkeypatch):
    made, real = [], substrings.PrefixHashes
    monkeypatch.setattr(substrings, "PrefixHashes", lambda data: made.append(len(data)) or real(data))
    monkeypatch.setattr(substrings, "each_batch", lambda docs, work, schema: work)
    rng = random.Random(13)
    rows = [prose(rng, 60) for _ in range(500)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(502)), "text": rows})
    found = substrings.anchors(None, 50)(batch)
    assert set(found["doc"].tolist()) == set(range(500))
    assert len(made) <= 4 and sum(made) == sum(len(t or "") for t in rows)


def test_suffix_sort_by_few_bytes_and_by_many():
    rng = np.random.default_rng(6)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    text = data.tobytes()
    for most in (1, 5, 8, 9, 40):
        starts = rng.permutation(2950)[:800]
        bucket = np.sort(rng.integers(0, 20, 800))
        order = substrings.suffix_sort(data, substrings.PrefixHashes(data), starts, bucket, most)
        keyed = [(b, text[s : s + most]) for b, s in zip(bucket.tolist(), starts.tolist())]
        assert order.tolist() == sorted(range(800), key=lambda i: keyed[i])


def test_stretches_of_neighbouring_texts_never_touch(spark):
    rng = random.Random(14)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(1, a, "en", "s"), (2, b, "en", "s"), (3, a, "en", "s"), (4, b, "en", "s"), (None, a + b, "en", "s"), (5, None, "en", "s")]
    out = {r["doc_id"]: r for r in substrings.deduplicate(docs_frame(spark, rows).coalesce(1)).collect()}
    assert [out[d]["spans"] for d in (1, 2, 5)] == [[], [], []]
    for d, t in ((3, a), (4, b)):
        assert [(s["start"], s["end"]) for s in out[d]["spans"]] == [(0, len(t))] and out[d]["kept"] == b""
    assert out[None]["kept"] == b"" and out[None]["n_bytes"] == len(a + b)
