"""Results next to plain Python over small corpora with planted copies."""

import hashlib
import random
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import docs_frame, prose
from tidemark.llm import decontamination, hosts, language, mixing, passages, quality, simhash, substrings, tokens, toxicity
from tidemark.llm.queries import tokenizer_path


def corpus(seed=1, n=60):
    """Texts over a small vocabulary, so that short strings repeat by chance; copies, near copies and shared passages."""
    rng = random.Random(seed)
    shared = [prose(rng, 70) for _ in range(3)]
    rows = []
    for i in range(n):
        kind = rng.randrange(6)
        text = prose(rng, rng.randint(0, 250))
        if kind == 1 and rows:
            text = rng.choice(rows)[1]
        elif kind == 2 and rows:
            words = rng.choice(rows)[1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == 3:
            text = f"{text} {rng.choice(shared)} {prose(rng, 20)}"
        elif kind == 4:
            text = prose(rng, 3, 5) + "ü" * rng.randrange(60) + prose(rng, 40, 6)
        rows.append((i * 7 % 1000, text, "en", f"s{i % 4}"))
    return rows


def test_substrings(spark):
    for big in (substrings.BIG, 3):
        rows = corpus(2)
        out = {r["doc_id"]: r for r in substrings.deduplicate(docs_frame(spark, rows), big=big).collect()}
        first = {}
        for d, t, *_ in sorted(rows):
            b = t.encode()
            for i in range(len(b) - 49):
                first.setdefault(b[i : i + 50], d)
        for d, t, *_ in rows:
            b = t.encode()
            gone = bytearray(len(b))
            for i in range(len(b) - 49):
                if first[b[i : i + 50]] < d:
                    gone[i : i + 50] = b"\x01" * 50
            assert out[d]["kept"] == bytes(x for x, g in zip(b, gone) if not g)
            assert sum(s["end"] - s["start"] for s in out[d]["spans"]) == sum(gone)


def test_suffix_sort_is_the_sorted_order():
    import numpy as np

    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.permutation(3900)[:2000]
    bucket = np.sort(rng.integers(0, 40, 2000))
    order = substrings.suffix_sort(data, substrings.PrefixHashes(data), starts, bucket, 30)
    text = data.tobytes()
    keyed = [(b, text[s : s + 30]) for b, s in zip(bucket.tolist(), starts.tolist())]
    assert order.tolist() == sorted(range(2000), key=lambda i: keyed[i])


def test_passages(spark):
    rows = corpus(5)
    out = {r["doc_id"]: r for r in passages.near_passages(docs_frame(spark, rows)).collect()}
    words = {d: decontamination.words_of(t.encode()) for d, t, *_ in rows}
    held = defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - 49):
            held[tuple(w[i : i + 50])].add(d)
    for docs in held.values():
        if len(docs) > 1:
            assert len({out[d]["class_id"] for d in docs}) == 1
            assert all(out[d]["passages"] for d in docs - {min(docs)})
    for d, r in out.items():
        for p in r["passages"]:
            a, b = words[d][p["start"] : p["end"]], words[p["other"]][p["other_start"] : p["other_end"]]
            grams = [{tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (a, b)]
            assert len(a) >= 50 and len(grams[0] & grams[1]) >= 0.8 * len(grams[0] | grams[1])
    assert sum(bool(r["passages"]) for r in out.values()) > 10


def test_compact_windows_are_all_wide_ones():
    import numpy as np

    rng = random.Random(6)
    for _ in range(200):
        values = [rng.randrange(0, 12) for _ in range(rng.randint(0, 40))]
        expected = []
        for c, v in enumerate(values):
            if v:
                lo, hi = c, c
                while lo and values[lo - 1] > v:
                    lo -= 1
                while hi + 1 < len(values) and values[hi + 1] >= v:
                    hi += 1
                expected += [(lo, c, hi)] if hi - lo + 1 >= 4 else []
        assert sorted(passages.compact_windows(np.array(values, dtype=np.uint64), 4)) == sorted(expected)


def test_simhash(spark):
    rows = corpus(7) + [(2000, None, "en", "s0"), (2001, "", "en", "s0")]
    out = {r["doc_id"]: r for r in simhash.near_duplicates(docs_frame(spark, rows)).collect()}
    prints = {}
    for d, t, *_ in rows:
        w = (t or "").lower().split()
        grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    group = {d: d for d in prints}

    def find(d):
        while group[d] != d:
            d = group[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                group[y] = x
    assert {d: (r["print"] % 2**64, r["component_id"]) for d, r in out.items()} == {d: (prints[d], find(d)) for d in ids}
    assert len({find(d) for d in ids}) < len(ids)


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(8).shuffle(order)
    edges = [(max(a, b), min(a, b)) for a, b in zip(order, order[1:])] + [(1001, 1000)]
    found = simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    expected = {i: 0 for i in range(1, n)} | {1001: 1000}
    assert {r["node"]: r["component"] for r in found if r["node"] != r["component"]} == expected


def test_tokens(spark):
    from tokenizers import Tokenizer

    rng = random.Random(10)
    odd = ["<|endoftext|>", "<|startoftext|>x", "don't", "İstanbul", "é", " ", " ", "ﬁ", "ΣΑΣ", "x" * 300, "12ab", "!?", "\x1c", "😀"]
    texts = [rng.choice([" ", "\n", ""]).join(rng.choice(odd) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    texts += [None, "", "a" * 5000]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    out = tokens.token_counts(docs_frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), tokenizer_path(), 20)
    for r in out.collect():
        t = texts[r["doc_id"]] or ""
        n = len(tokenizer.encode(t, add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(t.encode()), n > 20), t


def test_spans_of_contamination_point_into_the_original(spark):
    item = "Which  river—flows through the old town of Ulm, and where does it end up at last?"
    text = "Intro, intro. " + item.upper().replace("  ", " ... ") + " Outro."
    docs = docs_frame(spark, [(1, text, "en", "s"), (2, "nothing of it", "en", "s")])
    items = spark.createDataFrame([(7, item), (8, "of Ulm and")], "item_id bigint, text string")
    out = {r["doc_id"]: r for r in decontamination.decontaminate(docs, items).collect()}
    (span,) = out[1]["spans"]
    found = text.encode()[span["start"] : span["end"]]
    assert found.startswith(b"WHICH") and found.endswith(b"LAST") and out[1]["items"] == ["7", "8"]
    assert out[1]["contaminated"] and not out[2]["contaminated"]


def test_blocks_of_items_give_what_one_automaton_gives(spark, monkeypatch):
    rng = random.Random(11)
    rows = corpus(12)
    items = [(i, " ".join(rng.choice(rows)[1].split(" ")[5 : 5 + rng.randint(2, 30)])) for i in range(30)]
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    docs = docs_frame(spark, rows)
    one = sorted(map(tuple, decontamination.decontaminate(docs, frame).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    assert sorted(map(tuple, decontamination.decontaminate(docs, frame).collect())) == one


def test_mixture_meets_its_targets_and_repeats_itself(spark):
    rng = random.Random(13)
    rows = [(i, prose(rng, rng.randint(1, 40)), "en", rng.choice(["a", "b", "c", "c", "c", "c", None])) for i in range(2000)]
    docs = docs_frame(spark, rows)
    out = mixing.mix(docs).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, mixing.mix(docs.repartition(3)).collect()))
    taken, target = Counter(), {}
    for r in out:
        assert r["taken"] in {k * r["size"] for k in range(4)} and r["target"] <= 3 * r["source_size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert abs(sum(target.values()) - sum(r["size"] for r in out)) < 1e-6
    assert all(abs(taken[s] - t) <= 80 for s, t in target.items())


def test_shares_stop_at_three_times_a_source():
    assert mixing.shares({"a": 10, "b": 1000, None: 90}) == {"a": 30.0, None: 270.0, "b": 800.0}
    assert mixing.shares({}) == {} and mixing.shares({"a": 0}) == {"a": 0.0}


def test_hosts_shrink_towards_the_prior(spark):
    rng = random.Random(14)
    rows = [(i, prose(rng, 40), "en", f"h{i % 20}") for i in range(2000)]
    rows += [(5000 + i, "too short", "en", "bad") for i in range(200)] + [(6000 + i, prose(rng, 40), "en", "bad") for i in range(20)]
    rows += [(7000, "short", "en", "new"), (7001, prose(rng, 40), "en", "new")]
    out = {r["doc_id"]: r for r in hosts.host_rules(docs_frame(spark, rows)).collect()}
    assert not out[6000]["base_failed"] and not out[6000]["kept"]  # one good text of a bad host
    assert out[7001]["kept"] and 0.0 < out[7001]["host_short"] < 0.5 and not out[7000]["kept"]
    assert out[0]["kept"] and out[0]["host_docs"] == 100


def test_repeated_words():
    rng = random.Random(15)
    for _ in range(300):
        words = [str(rng.randrange(3)).encode() for _ in range(rng.randint(0, 60))]
        grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(8)}
        assert hosts.repeated_words(words) == len(covered)


def test_language_accuracy_held_out(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    out = language.identify(docs, docs.filter("doc_id % 4 <> 2"), keep=("lang",)).filter("doc_id % 4 = 2").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in out) >= 0.97 * len(out)


def test_cross_parse_counts_longest_phrases():
    texts = {"x": b"abracadabra", "y": b"bananas and"}
    automata = language.Automata(texts)
    rng = random.Random(16)
    for _ in range(100):
        t = bytes(rng.choice(b"abrcdn s?") for _ in range(rng.randint(1, 40)))
        for k, lang in enumerate(automata.langs):
            phrases, i = 0, 0
            while i < len(t):
                n = 1
                while i + n < len(t) and t[i : i + n + 1] in texts[lang]:
                    n += 1
                phrases, i = phrases + 1, i + n
            assert automata.phrases([t])[0, k] == phrases, (t, lang)


def _held_out(spark, sf_dir, score, label):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, labels.filter("doc_id % 4 <> 2").select("doc_id", label)).select("doc_id", "predicted", "score")
    rows = out.join(labels.filter("doc_id % 4 = 2"), "doc_id").collect()
    return Counter((r[label], r["predicted"]) for r in rows)


def test_toxicity_held_out(spark, sf_large):
    found = _held_out(spark, sf_large, toxicity.score, "toxic")
    assert found[1, 1] >= 0.85 * (found[1, 1] + found[1, 0]) and found[0, 1] <= 0.02 * (found[0, 0] + found[0, 1])


def test_toxic_spans_cover_the_insult(spark, sf_large):
    docs, labels = (spark.read.parquet(f"{sf_large}/{t}.parquet") for t in ("documents", "labels"))
    extra = docs_frame(spark, [(-1, "And the ring of thing, you STUPID idiot, thon is it.", "en", "s")])
    out = toxicity.score(docs.filter("doc_id < 0").unionByName(extra), labels.select("doc_id", "toxic").limit(0)).collect()
    assert out[0]["predicted"] == 0  # nothing learned
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic")
    text = b"And the ring of thing, you STUPID idiot, thon is it."
    (parts, p), = model.tag([text], toxicity.Levels(model.signs))
    at = [i for a, z in parts for i in range(a, z + 1)]
    words = toxicity.tokens_of(text)
    assert {words[i] for i, q in zip(at, p) if q > 0.5} == {b"stupid", b"idiot"}


def test_quality_held_out(spark, sf_large):
    found = _held_out(spark, sf_large, quality.score, "quality")
    assert found[0, 0] >= 0.9 * (found[0, 0] + found[0, 1]) and found[1, 0] <= 0.02 * (found[1, 0] + found[1, 1])


def test_rules_are_paths_of_the_tree():
    tree = (
        "DecisionTreeClassificationModel: depth=2\n  If (feature 0 <= 1.5)\n   If (feature 2 <= -0.25)\n    Predict: 0.0\n"
        "   Else (feature 2 > -0.25)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    )
    assert quality.paths_of(tree) == [
        ((0, "<=", 1.5),), ((0, "<=", 1.5), (2, "<=", -0.25)), ((0, "<=", 1.5), (2, ">", -0.25)), ((0, ">", 1.5),)
    ]


def test_pipeline_stages(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_small).collect()} == set(groups.values())
    cut = {r["doc_id"]: r for r in corpus_pipeline.drop_repeated_substrings(spark, docs, sf_small).collect()}
    assert set(cut) == set(given) and all(len(r["text"]) == r["n_chars"] <= len(given[d]) for d, r in cut.items())
    held = Counter()
    for d, r in cut.items():
        held.update({hashlib.md5(r["text"][i : i + 120].encode()).digest() for i in range(0, len(r["text"]) - 119)})
    assert max(held.values(), default=0) <= 1
    out = corpus_pipeline.run(spark, sf_small)
    assert 0 < out.count() <= len(given) and out.filter(F.col("taken") > 3 * F.col("size")).count() == 0
