"""The pairs of texts that share a passage go in rounds; the rows are those of one round."""

import random

from tests.llm.helpers import docs_frame, prose
from tidemark.llm import passages


def rows():
    """A passage that 90 texts hold, each with other words changed, beside copies, repeated and null ids."""
    rng = random.Random(31)
    stock = prose(rng, 110, 5000).split()
    out = []
    for i in range(90):
        own = list(stock)
        for at in rng.sample(range(110), 2):
            own[at] = f"other{i}"
        out.append((i * 7 % 1000, f"{prose(rng, 30, 5000)} {' '.join(own)} {prose(rng, 30, 5000)}", "en", "s"))
    return out + [(1000, out[3][1], "en", "s"), (1000, out[5][1], "en", "s"), (None, out[8][1], "en", "s"), (1001, None, "en", "s")]


def test_rounds_change_no_row(spark, monkeypatch):
    docs = docs_frame(spark, rows())
    stored, real = [], passages._stored
    monkeypatch.setattr(passages, "_stored", lambda df, name: stored.append(name) or real(df, name))

    def result():
        stored.clear()
        return sorted(map(repr, passages.near_passages(docs).collect())), stored.count("passage-candidates"), stored.count("passages")

    whole, meetings, checks = result()
    assert (meetings, checks) == (1, 1) and sum("similarity" in r for r in whole) > 60
    monkeypatch.setattr(passages, "PAIRS", 1000)
    monkeypatch.setattr(passages, "PIECES", 200_000)
    some, meetings, checks = result()
    assert meetings > 1 and checks > 1, (meetings, checks)
    assert some == whole
