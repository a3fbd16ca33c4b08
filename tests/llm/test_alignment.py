"""Alignment of two tokenizers next to whole texts encoded and aligned token by token."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import awkward_rows, docs_frame, prose
from tidemark.llm import alignment
from tidemark.llm.queries import tokenizer_path

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def brute(rows):
    """Per row: tokens of the whole text, cut where both end, all overlapping pairs; then counts over rows."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(A))
    a.encode_special_tokens = True
    back = {c: bytes([b]) for c, b in alignment.byte_letters().items()}
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") else p.replace("▁", " ").encode()

    found = []
    for _, text in rows:
        full = (" " + (text or "")).encode()
        ia = a.encode(full.decode(), add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ba = [b"".join(back[c] for c in a.id_to_token(i)) for i in ia]
        bb = [piece(i) for i in ib]
        if not text or b"".join(ba) != full or b"".join(bb) != full:
            found.append((0, 0, [], []))
            continue
        ends_a, ends_b = [0], [0]
        for x in ba:
            ends_a.append(ends_a[-1] + len(x))
        for x in bb:
            ends_b.append(ends_b[-1] + len(x))
        both = sorted(set(ends_a[1:]) & set(ends_b[1:]))
        groups, links, at_a, at_b = [], [], 0, 0
        for cut in both:
            ga, gb = [], []
            while at_a < len(ia) and ends_a[at_a + 1] <= cut:
                ga.append(at_a)
                at_a += 1
            while at_b < len(ib) and ends_b[at_b + 1] <= cut:
                gb.append(at_b)
                at_b += 1
            links += [
                (ia[i], ib[j])
                for i in ga
                for j in gb
                if max(ends_a[i], ends_b[j]) < min(ends_a[i + 1], ends_b[j + 1])
            ]
            groups.append(",".join(str(ia[i]) for i in ga) + "|" + ",".join(str(ib[j]) for j in gb))
        found.append((len(ia), len(ib), groups, links))
    n = Counter(p for *_, links in found for p in set(links))
    most = defaultdict(int)
    for (i, _), c in n.items():
        most[i] = max(most[i], c)
    out = []
    for (d, _), (na, nb, groups, links) in zip(rows, found):
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(n[p] == most[p[0]] for p in links)
        out.append((d, na, nb, len(groups), len(links), best, sum(n[p] for p in links), digest))
    return out, n


def odd_texts(seed=2, n=150):
    rng = random.Random(seed)
    parts = ["the", " ", "  ", "\n", "\t", "a.b", "don't", "1234567", "é", "ß", "日本", " ", "▁", "<s>", "</s>"]
    parts += ["<|endoftext|>", "<unk>", "\U0001f600", "\r\n", "\u0000", "　", "Ünder", "x" * 30, ",", "'s", "<0x41>", "ﬁ", "①", "​", "é", "\x1c"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5])
def test_rows_and_counts(spark, frequent):
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(0, 60)) for _ in range(20)] + odd_texts() + [None, "", " ", "  ", "a ", "\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4])]
    out, counts = alignment.align(
        docs_frame(spark, [(d, t, "en", "a") for d, t in rows]), tokenizer_path(A), tokenizer_path(B), frequent=frequent
    )
    expected, n = brute(rows)
    assert sum(1 for r in expected if r[1]) > 100
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expected))
    assert {(r["a"], r["b"]): r["n"] for r in counts.collect()} == dict(n)


def test_awkward_and_empty(spark):
    rows = awkward_rows()
    out, _ = alignment.align(docs_frame(spark, rows, clashing=True), tokenizer_path(A), tokenizer_path(B))
    expected, _ = brute([(d, t) for d, t, *_ in rows])
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expected))
    none, pairs = alignment.align(docs_frame(spark, []), tokenizer_path(A), tokenizer_path(B))
    assert none.collect() == [] and pairs.collect() == []


def test_remembered_chunks_start_over(spark, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    one = alignment.Aligner(tokenizer_path(A), tokenizer_path(B))
    texts = [t.encode() for t in odd_texts(5, 30)]
    whole = alignment.Aligner(tokenizer_path(A), tokenizer_path(B)).texts(texts)
    for i, t in enumerate(texts):
        own = one.texts([t])
        assert own["groups_sha256"] == [whole["groups_sha256"][i]]
        assert own["pairs"].to_pylist() == [whole["pairs"][i].as_py()]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        alignment.TokenizerA(tokenizer_path("word_bpe_49k.json"))


def test_ranks_and_library_give_the_same_ids():
    path = tokenizer_path(A)
    a = alignment.TokenizerA(path)
    texts = [" " + t for t in odd_texts(9, 300)]
    assert a.encode(texts) == a._by_library(path)(texts)
