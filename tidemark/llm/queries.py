"""One query per operator over its whole table, with the SQL that checks it where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    decontamination,
    hosts,
    language,
    minhash,
    mixing,
    passages,
    quality,
    simhash,
    substrings,
    tokens,
    toxicity,
    trie,
)

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id, n: int):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def held_out(n: int, k: int):
    return F.coalesce(remainder("doc_id", n) == k, F.lit(False))


def op1_host_rules(spark, sf_dir):
    out = hosts.host_rules(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_suffix_dedup(spark, sf_dir):
    out = substrings.deduplicate(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), TOKEN_LIMIT)


def op4_near_passages(spark, sf_dir):
    out = passages.near_passages(table(spark, sf_dir, "documents"))
    inside = F.size(F.array_distinct(F.flatten(F.transform("passages", lambda p: F.sequence(p["start"], p["end"] - 1)))))
    return out.select(
        "doc_id",
        "n_words",
        F.size("passages").cast("bigint").alias("n_passages"),
        inside.cast("bigint").alias("n_shared_words"),
        F.array_sort(F.array_distinct("passages.other")).alias("linked"),
        "class_id",
        "n_links",
    )


def op5_decontamination(spark, sf_dir):
    out = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_simhash(spark, sf_dir):
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = toxicity.score(docs, labels.filter(remainder("doc_id", 4) != 2).select("doc_id", "toxic"))
    return out.select("doc_id", held_out(4, 2).alias("held_out"), "score", "predicted")


def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    learn = docs.filter(remainder("doc_id", 4) != 2).select("text", "lang")
    out = language.identify(docs, learn)
    return out.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op9_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality.score(docs, labels.filter(remainder("doc_id", 3) != 1).select("doc_id", "quality"))
    return out.select("doc_id", held_out(3, 1).alias("held_out"), "score", "predicted")


def op10_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    nodes, _ = trie.prefix_trie(table(spark, sf_dir, "conversations"), trie.head_of_fifth)
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def op13_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))[0]


QUERIES = {
    "op1_host_rules": op1_host_rules,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_near_passages": op4_near_passages,
    "op5_decontamination": op5_decontamination,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_language": op8_language,
    "op9_quality": op9_quality,
    "op10_mixing": op10_mixing,
    "op11_minhash": op11_minhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_alignment": op13_alignment,
}

ORACLES = {
    "op1_host_rules": hosts.SQL,
    "op2_suffix_dedup": substrings.SQL,
    "op5_decontamination": decontamination.SQL,
    "op10_mixing": mixing.SQL,
    "op11_minhash": minhash.SQL,
    "op12_prefix_trie": trie.SQL,
}
