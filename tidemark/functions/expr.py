"""Small column expressions: dates, money, percentages, row hashes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: Column | str) -> Column:
    """Calendar day of a timestamp as YYYY-MM-DD text, the form of every partition value."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return column.cast("date").cast("string")


def week_start(ts: Column | str) -> Column:
    """Monday of the week as a date."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.trunc(column.cast("date"), "week")


def rupees(paise: Column) -> Column:
    """Integer paise to rupees; money is summed as integers and divided once, at the end."""
    return paise.cast("double") / F.lit(100.0)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with two decimals, half up; null when ``whole`` is zero or null.

    Rounding happens on integers, so the result does not depend on how an engine rounds doubles.
    """
    part, whole = part.cast("bigint"), F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    hundredths = F.call_function("div", part * 20000 + whole, whole * 2)
    return hundredths.cast("double") / F.lit(100.0)


def mean(total: Column, count: Column) -> Column:
    """Average from an exact integer sum and a count; null for no rows."""
    return total.cast("double") / F.nullif(count, F.lit(0).cast("bigint")).cast("double")


def row_hash(columns: Iterable[str]) -> Column:
    """64-bit hash of a row.

    A null leaves the running hash as it is, so (null, 5) and (5, null) would collide; the pattern of
    nulls is hashed along with the values.
    """
    columns = list(columns)
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return F.xxhash64(*[F.col(c) for c in columns], nulls)
