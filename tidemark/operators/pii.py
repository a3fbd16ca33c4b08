"""PII over whole tables: counts, known names, leak scan, clean gate, audit records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import redaction

# Words of identifiers and texts for the leak scan: letters, digits and the punctuation inside mail
# addresses, payment addresses, phone numbers and names.
SCAN_TOKEN = r"[\p{L}\p{N}_@+%'.\-]+"


class PiiError(Exception):
    """Text that must be clean is not. The message has kinds and counts, never values."""


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out over all tasks, by ``keys`` if there are any.

    Searching a text takes far longer than reading it: a table of a few bytes a row is read by one or two tasks, which would
    then search the texts of millions of rows.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def redact_text(df: DataFrame, text: str) -> DataFrame:
    """Replace ``text`` by its redacted form and add the array ``findings``."""
    return _apply_spans(df.withColumn("_spans", redaction.taken_spans(F.col(text))), df.columns, text)


def _apply_spans(df: DataFrame, columns: list[str], text: str) -> DataFrame:
    return df.select(
        *[redaction.without(F.col(c), F.col("_spans")).alias(c) if c == text else c for c in columns],
        redaction.findings_of(F.col("_spans")).alias("findings"),
    )


def counts_by_kind(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Findings per kind and group, zero counts included: one pass, combined on the map side."""
    kinds = list(redaction.PATTERNS)
    found = df.select(*by, redaction.findings(F.col(text)).alias("_f"))

    def hits(kind: str) -> Column:
        return F.sum(F.size(F.filter("_f", lambda k: k == kind)).cast("bigint"))

    totals = found.groupBy(*by).agg(*[hits(k).alias(k) for k in kinds])
    return totals.unpivot(by, kinds, "kind", "hits")


def word_runs(words: str, n: int) -> Column:
    """All runs of ``n`` consecutive words, joined by blanks: the word array zipped with itself, shifted."""
    grams = F.col(words)
    for shift in range(1, n):
        shifted = F.slice(F.col(words), shift + 1, F.size(words))
        grams = F.zip_with(grams, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
    # The last n - 1 positions met no partner and are null.
    return F.slice(grams, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))


def _name_grams(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every run of 2 to 4 name words with its word position: ``(key, at, words, gram)``."""
    tokens = df.select(
        key, F.regexp_extract_all(F.col(text), F.lit(redaction.TOKEN_PATTERN), F.lit(0)).alias("tok")
    )
    lowered = tokens.select(key, F.transform("tok", F.lower).alias("tok"))

    def run(n: int) -> Column:
        return F.transform(
            word_runs("tok", n), lambda g, i: F.struct(i.alias("at"), F.lit(n).alias("words"), g.alias("gram"))
        )

    grams = F.concat(*[run(n) for n in redaction.NAME_LENGTHS])
    return lowered.select(key, F.explode(grams).alias("g")).select(key, "g.at", "g.words", "g.gram")


def known_names(names: DataFrame, name: str) -> DataFrame:
    """Distinct lower-case names of at least two words; single words are too common to redact."""
    # Filtered before the key is formed: a filter on the join key would be repeated on every word run.
    several = names.filter(F.trim(F.col(name)).rlike(r"\S\s+\S"))
    return several.select(F.lower(F.trim(F.col(name))).alias("gram")).distinct()


def redact_known_names(df: DataFrame, key: str, text: str, names: DataFrame, name: str) -> DataFrame:
    """Redact names from a table along with the patterned kinds; ``key`` must identify a row.

    Rows are dealt out by ``key`` once, and what is found in a text meets its row there. Word runs meet the names in an
    equi-join, which the planner broadcasts or shuffles by the size of the names; a run that makes up a large part of all
    runs is split by adaptive execution. What comes back per text are only its matches. Only texts with matches have their
    words located.
    """
    dealt = spread(df, key)
    matched = _name_grams(dealt, key, text).join(known_names(names, name), "gram")
    per_row = matched.groupBy(key).agg(F.collect_list(F.struct("at", "words")).alias("_names"))
    words = F.regexp_extract_all(F.col(text), F.lit(redaction.TOKEN_PATTERN), F.lit(0))
    places = redaction.offsets(F.split(F.col(text), redaction.TOKEN_PATTERN, -1), words, 0)
    found = dealt.join(per_row, key, "left").withColumn("_places", F.when(F.col("_names").isNotNull(), places))

    def span(m: Column) -> Column:
        first, last = F.col("_places")[m["at"]], F.col("_places")[m["at"] + m["words"] - 1]
        return redaction.name_span(first["start"], -last["neg_stop"])

    with_names = found.withColumn("_name_spans", F.transform(F.col("_names"), span))
    spans = redaction.taken_spans(F.col(text), F.col("_name_spans"))
    return _apply_spans(with_names.withColumn("_spans", spans), df.columns, text)


def unclean_rows(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text still holds something redaction would replace.

    The text may itself be the result of redaction: it is computed once, not once per pattern.
    """
    return df.filter(redaction.let(F.col(text), redaction.contains_pii))


def assert_clean(df: DataFrame, text: str, where: str = "export") -> None:
    """Gate before text leaves the platform: raise with kinds and row counts when any row is unclean."""
    kinds = (
        unclean_rows(df, text)
        .select(F.explode(F.array_distinct(redaction.findings(F.col(text)))).alias("kind"))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    found = {r["kind"]: r["rows"] for r in kinds.collect()}  # at most one row per kind
    if found:
        raise PiiError(f"{where} contains PII-like content: {found}")


def intent_flags(df: DataFrame, text: str) -> DataFrame:
    """Flag text that asks for personal data. Redact first: placeholders are ignored."""
    return df.withColumn("asks_for_pii", redaction.asks_for_pii(F.col(text)))


def refusal_rate(df: DataFrame, text: str, by: str) -> DataFrame:
    flagged = intent_flags(df.select(by, text), text)
    return flagged.groupBy(by).agg(
        F.count(F.lit(1)).alias("questions"), F.count_if(F.col("asks_for_pii")).alias("refused")
    )


def identifiers(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct ``(kind, value)`` of every PII-tagged column of the given tables."""
    parts = []
    for name, df in tables.items():
        tagged = [f.name for f in df.schema.fields if f.metadata.get("pii")]
        if tagged:
            kinds = df.select(*[F.col(c).cast("string") for c in tagged]).unpivot([], tagged, "kind", "value")
            parts.append(kinds.select(F.concat(F.lit(f"{name}."), "kind").alias("kind"), "value"))
    return reduce(DataFrame.unionByName, parts).filter(F.col("value").isNotNull()).distinct()


# How an identifier is looked for. Addresses and numbers are found wherever their characters stand, whatever stands
# beside them; names and the like are found between word boundaries.
_SHAPES = {"plus": r"^\+[0-9]+$", "digits": r"^[0-9]+$", "address": r"^[^@]+@[^@]+$"}


def _shape(value: Column) -> Column:
    shape = F.lit("words")
    for name, pattern in reversed(_SHAPES.items()):
        shape = F.when(value.rlike(pattern), name).otherwise(shape)
    return shape


def _number_runs(text: Column, plus: list[int], digits: list[int]) -> list[Column]:
    """Parts of the digit runs of a text: beginnings after a plus sign, and all parts, of the given lengths."""
    runs = F.regexp_extract_all(text, F.lit(r"\+?[0-9]+"), F.lit(0))
    signed = F.filter(runs, lambda r: r.startswith("+"))
    bare = F.transform(runs, lambda r: F.ltrim(r, F.lit("+")))

    def beginnings(n: int) -> Column:
        return F.transform(F.filter(signed, lambda r: F.length(r) > n), lambda r: F.substring(r, 1, n + 1))

    def parts(n: int) -> Column:
        long = F.filter(bare, lambda r: F.length(r) >= n)
        starts = lambda r: F.sequence(F.lit(1), F.length(r) - (n - 1))
        return F.flatten(F.transform(long, lambda r: F.transform(starts(r), lambda i: F.substring(r, i, F.lit(n)))))

    return [beginnings(n) for n in plus] + [parts(n) for n in digits]


def _address_runs(text: Column, sides: list[tuple[int, int]]) -> list[Column]:
    """What stands around each @ of a text, as many characters to either side as addresses have."""
    parts = F.split(text, "@", -1)
    pairs = F.zip_with(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        F.slice(parts, F.lit(2), F.size(parts)),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )

    def around(before: int, after: int) -> Column:
        enough = F.filter(pairs, lambda p: (F.length(p["a"]) >= before) & (F.length(p["b"]) >= after))
        return F.transform(
            enough, lambda p: F.concat(F.right(p["a"], F.lit(before)), F.lit("@"), F.left(p["b"], F.lit(after)))
        )

    return [F.when(F.size(parts) > 1, around(b, a)) for b, a in sides]


def leak_scan(values: DataFrame, corpus: DataFrame, text: str) -> DataFrame:
    """Identifiers that occur in a corpus, with the number of texts that hold them.

    Numbers (with or without a plus sign) and addresses occur wherever a text holds them, as in a search for substrings:
    candidates are cut out around every ``@`` and from every run of digits, in the lengths that identifiers have.
    Other identifiers occur when their words follow each other, delimited on both sides. Candidates, each once per text,
    meet the identifiers in one equi-join; the planner broadcasts the identifiers if they are small.

    An identifier without a letter, digit or ``@`` cannot be looked for: it is returned with null ``texts``.
    """
    pattern = F.lit(SCAN_TOKEN)

    def words(column: str) -> Column:
        found = F.regexp_extract_all(F.col(column), pattern, F.lit(0))
        bare = F.transform(found, lambda w: F.btrim(w, F.lit(".'-")))
        return F.filter(bare, lambda w: F.length(w) > 0)

    value, at = F.col("value"), F.instr("value", "@")
    keyed = values.withColumns({"shape": _shape(value), "_w": words("value")}).select(
        "kind",
        "value",
        "shape",
        F.when(F.col("shape") == "words", F.array_join("_w", " ")).otherwise(value).alias("run"),
        F.when(F.col("shape") == "words", F.size("_w"))
        .when(F.col("shape") == "address", at - 1)
        .otherwise(F.length(F.ltrim("value", F.lit("+"))))
        .alias("n"),
        F.when(F.col("shape") == "address", F.length("value") - at).otherwise(0).alias("after"),
    )
    # The distinct lengths: some dozens, whatever the number of identifiers.
    sizes: dict[str, list] = {k: [] for k in (*_SHAPES, "words")}
    for r in keyed.select("shape", "n", "after").distinct().orderBy("shape", "n", "after").collect():
        sizes[r["shape"]].append((r["n"], r["after"]) if r["shape"] == "address" else r["n"])
    tokens = spread(corpus.select(text)).select(F.col(text).alias("_t"), words(text).alias("_w"))
    every = [
        *(word_runs("_w", n) for n in sizes["words"] if n),
        *_number_runs(F.col("_t"), sizes["plus"], sizes["digits"]),
        *_address_runs(F.col("_t"), sizes["address"]),
    ]
    none = F.array().cast("array<string>")
    runs = tokens.select(F.explode(F.array_distinct(F.concat(none, *(F.coalesce(e, none) for e in every)))).alias("run"))
    searchable = (F.col("shape") != "words") | (F.col("n") > 0)
    hits = runs.join(keyed.filter(searchable).select("kind", "value", "run"), "run")
    found = hits.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("texts"))
    unsearchable = keyed.filter(~searchable).select("kind", "value", F.lit(None).cast("bigint").alias("texts"))
    return found.unionByName(unsearchable)


def redact_records(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Redact every text of log records, nested ones included, the last step before they are written.

    Records repeat their texts: each is redacted once per record, however many fields hold it.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields if redaction.holds_text(f.dataType)}
    chosen = columns or list(kinds)
    chosen = [c for c in chosen if c in kinds]
    if not chosen:
        return df
    texts = F.concat(*[redaction.texts_within(F.col(f"`{c}`"), kinds[c]) for c in chosen])
    known = df.withColumn("_clean", redaction.redact_all(texts))
    return known.withColumns(
        {c: redaction.redact_within(F.col(f"`{c}`"), kinds[c], F.col("_clean")) for c in chosen}
    ).drop("_clean")


def write_audit_log(df: DataFrame, path: str) -> None:
    """Append redacted records as JSON lines."""
    redact_records(df).write.mode("append").json(path)
