"""The fit reads whole documents, and a sample that does not hang on their order."""

import numpy as np

from tidemark.llm import toxicity

FIELD = toxicity.Field(np.array([0.0] + [-1.0] * toxicity.LEVELS), np.zeros((2, 2)), np.zeros(2))
PART = bytes([0, 0, 0, 0, 1, 0, 0, 0, 0])


def frame(spark, rows):
    return spark.createDataFrame(rows, "toxic int, pick bigint, parts array<binary>")


def test_summaries_are_those_of_whole_documents(spark):
    parts = [PART] * 30 + [bytes([0, 7, 0])]
    (row,) = toxicity.document_summaries(frame(spark, [(0, 1, parts)]), FIELD)
    p = np.concatenate(FIELD.tagged([np.frombuffer(x, dtype=np.uint8) for x in parts]))
    assert np.allclose([1.0, row["surprise"], row["most"]], toxicity.summaries([p])[0])


def test_stretches_come_from_all_over_the_documents_in_any_order(spark, monkeypatch):
    rows = [(i % 2, i * 7919, [bytes([k % 7 + 1, k // 7 + 1, i % 5]) for k in range(40)]) for i in range(50)]
    monkeypatch.setattr(toxicity, "TRAIN_STRETCHES", 100)
    given = toxicity.sampled_stretches(frame(spark, rows))
    assert given == toxicity.sampled_stretches(frame(spark, rows[::-1]).repartition(3)) and len(given) == 100
    late = sum(n for (levels, _), n in given.items() if levels[1] * 7 + levels[0] - 8 >= 20)
    assert 0.3 < late / sum(given.values()) < 0.7
