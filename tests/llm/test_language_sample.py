"""What the automata learn from: copies and long texts must not take the place of other texts."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs_frame
from tidemark.llm import language


def words(rng, n, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 7))) for _ in range(n))


def test_copies_take_no_ranks_of_other_texts(spark):
    rng = random.Random(41)
    texts = [words(rng, 20, "abcdef") for _ in range(60)]
    frame = docs_frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    ranked = [r["text"] for r in frame.orderBy(F.xxhash64("text")).collect()]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts + [ranked[0]] * 60)]
    given = language.training_texts(docs_frame(spark, rows), "text", "lang")["en"]
    assert sum(language.letters_of(t) in given for t in ranked[:40]) == 40


@pytest.mark.parametrize("long_first", [True, False])
def test_a_long_text_leaves_the_others_their_share(long_first):
    rng = random.Random(42)
    mark = b"a" if long_first else b"z"
    long = mark + b" " + b" ".join(f"part{i} ".encode() + words(rng, 60, "xyz").encode() for i in range(400))
    others = [b"m" + words(rng, 30, "abc").encode() for _ in range(30)]
    out = language.sample_of([long, *others], language.TRAIN_BYTES)
    assert len(out) <= language.TRAIN_BYTES and all(t in out for t in others)
    seen = [i for i in range(400) if f"part{i} ".encode() in out]
    assert min(seen) < 100 and max(seen) >= 300
    # Long texts share what there is.
    both = language.sample_of([b"xy " * 50_000, b"qr " * 50_000], language.TRAIN_BYTES)
    assert abs(both.count(b"x") - both.count(b"q")) <= 20 and len(both) >= 0.95 * language.TRAIN_BYTES
