"""PII detection and redaction as column expressions.

Each kind is searched on its own over the whole text. All hits are then ordered by start, longest first,
and taken from left to right; a hit that starts inside one already taken is dropped as a whole. The
expressions that locate hits are evaluated only for rows in which a kind occurs at all.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds and their patterns, in order of precedence for equal spans.
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}",
    "VPA": r"(?<![\w.])[A-Za-z0-9._\-]{2,}@[A-Za-z][A-Za-z0-9]{1,}\b",
    "PAN": r"\b[A-Z]{5}\d{4}[A-Z]\b",
    "AADHAAR": r"(?<!\d)\d{4}[ -]\d{4}[ -]\d{4}(?!\d)",
    "PHONE": r"(?<![\d])(?:\+?91[\s-]?)?[6-9]\d{4}[\s-]?\d{5}(?!\d)",
    "UPI_REF": r"(?<!\d)\d{12}(?!\d)",
}

NAME = "NAME"  # fixed value: kind of a known person's name
TOKEN_PATTERN = r"[A-Za-z][A-Za-z.'\-]*"  # fixed value: one word of a name
NAME_LENGTHS = (4, 3, 2)  # fixed value: words per name that are looked for

# Fixed value: wording that asks for personal data, in any letter case.
INTENT_PATTERN = (
    r"\b(phone|mobile\s*(number|no)|e-?mail|vpa|upi\s*(id|ref\w*)|reference\s*number|rrn|"
    r"full\s*names?|customer\s*names?|user\s*names?|names?\s+of\s+(the\s+)?(users?|customers?|payers?)|"
    r"contact\s*(number|phone|details?))\b"
)
PLACEHOLDER_PATTERN = r"\[[A-Z_]+\]"  # fixed value: what redaction leaves behind

# \w, \d, \s and \b follow Unicode.
_FLAGS = "(?U)"
# A mail address can only begin where its run of local-part characters begins, or right after the
# previous hit. Saying so keeps the search linear on long runs, such as encoded blobs, and finds the same.
_ANCHORS = {"EMAIL": r"(?:\G|(?<![A-Za-z0-9._%+\-]))"}


def kind_pattern(kind: str) -> str:
    return _FLAGS + _ANCHORS.get(kind, "") + PATTERNS[kind]


_NEED_AT_SIGN = ("EMAIL", "VPA")


def _worth_searching(text: Column, kind: str) -> Column:
    """Mail and payment addresses need an ``@``, the other kinds four digits in a row. Both are far
    cheaper to look for than the kinds themselves."""
    return F.contains(text, F.lit("@")) if kind in _NEED_AT_SIGN else text.rlike(r"(?U)\d{4}")


def contains_pii(text: Column) -> Column:
    """True when redaction would change the text. Each cheap test runs once for all kinds that need it."""

    def any_of(kinds: list[str]) -> Column:
        found = reduce(lambda a, b: a | b, [text.rlike(kind_pattern(k)) for k in kinds])
        return _worth_searching(text, kinds[0]) & found

    addresses = [k for k in PATTERNS if k in _NEED_AT_SIGN]
    numbers = [k for k in PATTERNS if k not in _NEED_AT_SIGN]
    return F.coalesce(any_of(addresses) | any_of(numbers), F.lit(False))


_SPANS = "array<struct<start:int,neg_stop:int,rank:int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _chunks(items: Column) -> Column:
    """Stretches of about the square root of the array's size.

    Folding a stretch at a time keeps every array that grows step by step as short as a stretch, so the work for a text
    with many hits stays nearly proportional to their number.
    """
    n = F.size(items)
    width = F.greatest(F.lit(64), F.ceil(F.sqrt(n)).cast("int"))
    last = F.call_function("div", n - 1, width).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(items, c * width + 1, width))
    return F.when(n > 0, cut)


def _fold(items: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Spans from a fold over ``items`` whose state is a position in the text, ``pos``, and the spans so far, ``out``."""

    def chunk(acc: Column, part: Column) -> Column:
        own = F.aggregate(part, F.struct(acc["pos"].alias("pos"), _no_spans().alias("out")), step)
        return let(own, lambda r: F.struct(r["pos"].alias("pos"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{_SPANS}>").alias("out"))
    found = F.aggregate(_chunks(items), start, chunk, lambda acc: F.flatten(acc["out"]))
    return F.coalesce(found, _no_spans())


def offsets(gaps: Column, hits: Column, rank: int) -> Column:
    """Spans as (start, -stop, rank); sorting these orders by start, longest, precedence.

    ``gaps`` are what a split leaves between the hits, one more than there are hits.
    """

    def step(acc: Column, piece: Column) -> Column:
        start = acc["pos"] + piece["gap"]
        stop = start + piece["hit"]
        span = F.struct(start.alias("start"), (-stop).alias("neg_stop"), F.lit(rank).alias("rank"))
        return F.struct(stop.alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    before = F.slice(gaps, F.lit(1), F.size(hits))
    lengths = F.zip_with(
        before, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit"))
    )
    return let(lengths, lambda x: _fold(x, step))


def _spans(text: Column, kind: str, rank: int) -> Column:
    """Spans of one kind. The hits are extracted once; only texts that have any are split."""
    hits = F.when(
        _worth_searching(text, kind), F.regexp_extract_all(text, F.lit(kind_pattern(kind)), F.lit(0))
    )
    return let(
        hits,
        lambda found: F.when(
            F.size(found) > 0, offsets(F.split(text, kind_pattern(kind), -1), found, rank)
        ).otherwise(_no_spans()),
    )


def _no_spans() -> Column:
    return F.array().cast(_SPANS)


def name_span(start: Column, stop: Column) -> Column:
    """A span of a known name, for the ``names`` argument of :func:`taken_spans`."""
    rank = F.lit(len(PATTERNS))
    return F.struct(start.cast("int").alias("start"), (-stop).cast("int").alias("neg_stop"), rank.alias("rank"))


def taken_spans(text: Column, names: Column | None = None) -> Column:
    """Spans to replace, in text order and without overlaps. ``names`` adds spans found elsewhere.

    Select this into a column when both the clean text and the findings are needed.
    """
    found = [_spans(text, kind, i) for i, kind in enumerate(PATTERNS)]
    if names is not None:
        found.append(F.coalesce(names, _no_spans()))

    def step(acc: Column, span: Column) -> Column:
        grown = F.struct((-span["neg_stop"]).alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))
        return F.when(span["start"] >= acc["pos"], grown).otherwise(acc)

    taken = let(F.array_sort(F.concat(*found)), lambda x: F.when(F.size(x) > 1, _fold(x, step)).otherwise(x))
    # Most texts leave here.
    worth = _worth_searching(text, "EMAIL") | _worth_searching(text, "PHONE")
    if names is not None:
        worth = worth | (F.size(F.coalesce(names, _no_spans())) > 0)
    return F.coalesce(F.when(worth, taken), _no_spans())


def _label(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in (*PATTERNS, NAME)]), rank + 1)


def findings_of(spans: Column) -> Column:
    """Kinds of the spans in text order, with repetitions, never the values."""
    return F.transform(spans, lambda s: _label(s["rank"]))


def without(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[KIND]``.

    Each stretch of spans is cut out of the text once, and its pieces out of that, so no piece is looked for from
    the beginning of the text.
    """
    stop = lambda s: -s["neg_stop"]
    before = F.concat(F.array(F.lit(0)), F.transform(spans, stop))
    pieces = F.zip_with(
        spans,
        F.slice(before, F.lit(1), F.size(spans)),
        lambda s, b: F.struct(s["start"].alias("start"), s["neg_stop"].alias("neg_stop"), s["rank"].alias("rank"), b.alias("after")),
    )

    def replaced(chunk: Column) -> Column:
        base = chunk[0]["after"]
        local = F.substring(text, base + 1, stop(F.element_at(chunk, -1)) - base)

        def piece(own: Column, s: Column) -> Column:
            gap = F.substring(own, s["after"] - base + 1, s["start"] - s["after"])
            return F.concat(gap, F.lit("["), _label(s["rank"]), F.lit("]"))

        return let(local, lambda own: F.array_join(F.transform(chunk, lambda s: piece(own, s)), ""))

    head = let(pieces, lambda p: F.array_join(F.transform(_chunks(p), replaced), ""))
    tail = F.substring(text, F.element_at(before, -1) + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(head, tail)).otherwise(text)


def findings(text: Column) -> Column:
    return findings_of(taken_spans(text))


def redact(text: Column) -> Column:
    return let(taken_spans(text), lambda spans: without(text, spans))


def texts_within(value: Column, kind: T.DataType) -> Column:
    """Every text inside ``value``, repeated ones and nulls included."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        return F.array(value)
    if not holds_text(kind):
        return none
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.flatten(F.transform(value, lambda x: texts_within(x, kind.elementType))), none)
    if isinstance(kind, T.MapType):
        values = F.map_values(value)
        return F.coalesce(F.flatten(F.transform(values, lambda x: texts_within(x, kind.valueType))), none)
    return F.concat(
        *[texts_within(value.getField(f.name), f.dataType) for f in kind.fields if holds_text(f.dataType)]
    )


def redact_all(texts: Column) -> Column:
    """A map from each text of an array to its redacted form, each distinct one redacted once."""
    distinct = F.array_distinct(F.filter(texts, lambda t: t.isNotNull()))
    return let(distinct, lambda d: F.map_from_arrays(d, F.transform(d, redact)))


def redact_within(value: Column, kind: T.DataType, clean: Column) -> Column:
    """``value`` with every text inside it redacted: elements of arrays, values of maps, fields of structs.

    Keys of maps are names of fields and stay. ``clean`` maps every text to its redacted form (:func:`redact_all`).
    """
    if isinstance(kind, T.StringType):
        return clean[value]
    if not holds_text(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: redact_within(x, kind.elementType, clean))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda k, v: redact_within(v, kind.valueType, clean))
    for field in kind.fields:
        if holds_text(field.dataType):
            inner = redact_within(value.getField(field.name), field.dataType, clean)
            value = value.withField(f"`{field.name}`", inner)
    return value


def holds_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return holds_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return holds_text(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(holds_text(f.dataType) for f in kind.fields)
    return isinstance(kind, T.StringType)


def asks_for_pii(text: Column) -> Column:
    """True for text that asks for personal data; placeholders left by redaction do not count."""
    stripped = F.regexp_replace(text, PLACEHOLDER_PATTERN, "")
    return F.coalesce(stripped.rlike(f"(?iU){INTENT_PATTERN}"), F.lit(False))
