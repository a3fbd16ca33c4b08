"""What the trained models compute, next to plain enumeration: marginals of the field, scores of the rules."""

import itertools
import math
import random

import numpy as np

from tests.llm.helpers import docs_frame, prose
from tidemark.llm import quality, toxicity


def enumerated(field, levels):
    """P(toxic) of each place, by the weights of all sequences of tags."""
    total, toxic = 0.0, [0.0] * len(levels)
    for tags in itertools.product((0, 1), repeat=len(levels)):
        weight = field.start[tags[0]] + sum(field.level[x] for x, y in zip(levels, tags) if y)
        weight += sum(field.moves[a, b] for a, b in zip(tags, tags[1:]))
        p = math.exp(weight)
        total += p
        for i, y in enumerate(tags):
            toxic[i] += p * y
    return [t / total for t in toxic]


def test_marginals_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(1)
    for _ in range(20):
        field = toxicity.Field(rng.normal(size=toxicity.LEVELS + 1), rng.normal(size=(2, 2)), rng.normal(size=2))
        rows = [rng.integers(0, toxicity.LEVELS + 1, size=rng.integers(1, 9)) for _ in range(7)]
        for row, p in zip(rows, field.tagged(rows)):
            assert np.allclose(p, enumerated(field, row.tolist()))


def test_expected_moves_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(2)
    field = toxicity.Field(rng.normal(size=toxicity.LEVELS + 1), rng.normal(size=(2, 2)), rng.normal(size=2))
    rows = [rng.integers(0, toxicity.LEVELS + 1, size=n) for n in (2, 5, 7)]
    weights = np.array([1.0, 3.0, 0.5])
    pair = field.marginals(rows, weights)[3]
    expected = np.zeros((2, 2))
    for row, w in zip(rows, weights):
        total, own = 0.0, np.zeros((2, 2))
        for tags in itertools.product((0, 1), repeat=len(row)):
            p = math.exp(
                field.start[tags[0]]
                + sum(field.level[x] for x, y in zip(row, tags) if y)
                + sum(field.moves[a, b] for a, b in zip(tags, tags[1:]))
            )
            total += p
            for a, b in zip(tags, tags[1:]):
                own[a, b] += p
        expected += w * own / total
    assert np.allclose(pair, expected)


def test_rules_score_as_in_plain_python(spark):
    rng = random.Random(3)
    n = len(quality.STATS)
    rules = []
    for _ in range(30):
        path = tuple((rng.randrange(n), rng.choice(["<=", ">"]), rng.choice([0.0, 0.1, 0.5, 2.0, 20.0])) for _ in range(rng.randint(1, 4)))
        rules.append((path, rng.uniform(-2, 2)))
    model = quality.RuleEnsemble(-0.3, rules)
    texts = [prose(rng, rng.randint(0, 80)) for _ in range(30)] + ["", "!!! ### ", "A B C\nA B C\n", "x" * 500]
    docs = docs_frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    out = quality.document_stats(docs, "doc_id", "text").withColumn("score", model.score()).collect()
    assert len(out) == len(texts)
    for r in out:
        stats = quality.text_stats(texts[r["doc_id"]].encode())
        assert [r[k] for k in quality.STATS] == stats
        total = -0.3
        for path, weight in rules:
            if all(stats[k] <= v if sign == "<=" else stats[k] > v for k, sign, v in path):
                total += weight
        assert abs(r["score"] - 1 / (1 + math.exp(-total))) < 1e-12
