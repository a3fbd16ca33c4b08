"""Host-level quality rules: failures by domain, shrunk by an empirical beta prior, joined back to documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.skew import salted_join
from tidemark.llm.common import each_batch, prepared, texts_of
from tidemark.session import checkpointed

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PCT = 30
# A host is rejected if the shrunk share of its documents that fail a rule is above this.
MAX_RATE = 0.5
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(set(range(256)) - set(SYMBOLS))


def repeated_words(words: list[bytes], size: int = REPEAT_WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more, the first occurrence included.

    Hashes of windows tell which could be repeated; only those are compared word by word.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    odd = np.array([3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41][:size], dtype=np.uint64)
    ids = np.array(list(map(hash, words)), dtype=np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed = ids ^ (ids >> np.uint64(29))
    sums = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        sums += mixed[k : k + n] * odd[k] ** np.uint64(11)
    order = np.argsort(sums)
    same = sums[order][1:] == sums[order][:-1]
    if not same.any():
        return 0
    suspects = np.zeros(n, dtype=bool)
    suspects[order[1:][same]] = suspects[order[:-1][same]] = True
    seen: dict[tuple, list[int]] = {}
    for i in np.flatnonzero(suspects).tolist():
        seen.setdefault(tuple(words[i : i + size]), []).append(i)
    covered = np.zeros(len(words), dtype=bool)
    for starts in seen.values():
        if len(starts) > 1:
            for i in starts:
                covered[i : i + size] = True
    return int(covered.sum())


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def document_stats(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Counts of each text: words, characters in words, symbols, repeated lines, repeated words, lines."""

    def stats(batch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")}
        for t in texts_of(batch, text_col):
            words = t.split()
            solid = b"".join(words)
            out["n_words"].append(len(words))
            out["word_chars"].append(len(solid.decode()))
            out["n_symbols"].append(len(t.translate(None, _NOT_SYMBOLS)))
            out["n_dup_lines"].append(duplicate_lines(t))
            out["n_repeat_words"].append(repeated_words(words))
            out["n_lines"].append(sum(1 for x in t.split(b"\n") if x.strip()))
        return {id_col: batch.column(id_col), "host": batch.column(host_col)} | out

    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("host", T.StringType()),
            *(T.StructField(k, T.LongType()) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")),
        ]
    )
    return each_batch(docs.select(id_col, text_col, F.col(host_col).cast("string").alias(host_col)), stats, schema)


def rules() -> dict[str, Column]:
    """Rules on a document's counts; true means failed."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }


def priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and strength of each rule's beta prior, from the mean and variance of the hosts' rates.

    The strength counts as so many documents of an average host. It lies between 1 and 1,000; without variance
    (one host, or all alike) it is 1,000.
    """
    figures = []
    for rule in rules():
        rate = F.col(rule) / F.col("n")
        figures += [F.avg(rate).alias(f"{rule}_mean"), F.var_pop(rate).alias(f"{rule}_var")]
    row = hosts.agg(*figures).first()
    out = {}
    for rule in rules():
        mean, var = row[f"{rule}_mean"] or 0.0, row[f"{rule}_var"] or 0.0
        out[rule] = (mean, min(1000.0, max(1.0, mean * (1 - mean) / var - 1)) if var > 0 else 1000.0)
    return out


def host_verdicts(stats: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: documents, failures and shrunk failure rate of each rule, ``host_ok``."""
    failed = [F.count_if(test).alias(rule) for rule, test in rules().items()]
    hosts = checkpointed(stats.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *failed))
    known = priors(hosts)
    rate = {
        rule: (F.col(rule) + mean * strength) / (F.col("n") + strength) for rule, (mean, strength) in known.items()
    }
    return hosts.select(
        "host",
        F.col("n").alias("host_docs"),
        *(r.alias(f"host_{rule}") for rule, r in rate.items()),
        (F.greatest(*rate.values()) <= max_rate).alias("host_ok"),
    )


def host_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """One row per document with its counts, ``base_failed``, the shrunk rates of its host and ``kept``.

    A document fails the base if it has fewer than 20 words or more than 30% of its words are in repeated 8-word
    windows. It is kept if it passes the base and its host passes: for no rule is the host's failure rate, shrunk
    towards that of all hosts, above ``max_rate``.

    Failures are summed per host where the documents are read; the verdicts return by a join that spreads a hot host
    over salts. Null or empty text: no words, base failed. Null host: a host of its own. Null id: as it is.
    Empty input: no rows.
    """
    prepared(docs.sparkSession)
    stats = checkpointed(document_stats(docs, id_col, text_col, host_col).withColumn("known", F.col("host").isNotNull()))
    keyed = stats.withColumn("host", F.coalesce("host", F.lit("")))
    verdicts = host_verdicts(keyed.withColumn("host", F.struct("host", "known")), max_rate)
    verdicts = verdicts.select("host.host", "host.known", *verdicts.columns[1:])
    return salted_join(
        keyed.withColumn("_row", F.monotonically_increasing_id()), verdicts, ["host", "known"], F.col("_row"), "left"
    ).select(
        id_col,
        F.when(F.col("known"), F.col("host")).alias("host"),
        *stats.columns[2:-1],
        *verdicts.columns[2:],
        (rules()["short"] | rules()["repeats"]).alias("base_failed"),
        (~rules()["short"] & ~rules()["repeats"] & F.col("host_ok")).alias("kept"),
    )


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FAILS = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "100 * n_dup_lines > 30 * n_lines",
}
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, * FROM documents),
w AS (SELECT r, doc_id, source, {_WORDS} AS words, text FROM d),
win AS (
  SELECT r, i, hash(x) AS x, x AS exact FROM (
    SELECT r, i, array_to_string(words[i:i + 7], ' ') AS x
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8))),
rep AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, exact) > 1),
repeated AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM rep) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d WHERE text IS NOT NULL)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
stats AS (
  SELECT w.doc_id, w.source, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(l.dup, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words, coalesce(l.n_lines, 0) AS n_lines
  FROM w LEFT JOIN repeated p USING (r) LEFT JOIN lines l USING (r)),
hosts AS (SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER (WHERE {t}) AS {k}" for k, t in _FAILS.items())}
          FROM stats GROUP BY source),
prior AS (SELECT {", ".join(f"avg({k} / n) AS {k}_m, var_pop({k} / n) AS {k}_v" for k in _FAILS)} FROM hosts),
strong AS (SELECT *, {", ".join(f"CASE WHEN {k}_v > 0 THEN least(1000, greatest(1, {k}_m * (1 - {k}_m) / {k}_v - 1)) ELSE 1000 END AS {k}_s" for k in _FAILS)} FROM prior),
verdicts AS (SELECT source, {" AND ".join(f"({k} + {k}_m * {k}_s) / (n + {k}_s) <= {MAX_RATE}" for k in _FAILS)} AS ok
             FROM hosts CROSS JOIN strong)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {_FAILS["short"]} OR {_FAILS["repeats"]} AS base_failed,
       NOT ({_FAILS["short"]} OR {_FAILS["repeats"]}) AND ok AS kept
FROM stats s JOIN verdicts v ON s.source IS NOT DISTINCT FROM v.source
"""
