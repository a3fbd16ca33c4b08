"""Scan-cost accounting and latency figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ordering import values_at

MAX_SCAN_ROWS = 200_000  # fixed value: rows a guarded read may scan by estimate


def storage_growth(manifest: DataFrame) -> DataFrame:
    """Rows, bytes, running total of bytes and bytes per row, partition by partition.

    The running total is over the manifest, one row per table and day, never over the data.
    """
    before = Window.partitionBy("table_name").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    hundredths = F.call_function("div", F.col("bytes") * 200 + F.col("rows"), F.col("rows") * 2)
    return manifest.select(
        "table_name",
        "dt",
        "rows",
        "bytes",
        F.sum("bytes").over(before).alias("cumulative_bytes"),
        (hundredths.cast("double") / F.lit(100.0)).alias("bytes_per_row"),
    )


def scan_estimate(
    manifest: DataFrame, requests: DataFrame, max_scan_rows: int = MAX_SCAN_ROWS
) -> DataFrame:
    """Estimated cost of reads before they run, from exact row counts per partition.

    ``requests``: ``request_id, table_name, dt_from, dt_to`` with inclusive bounds, null for open. A table
    without manifest rows has unknown statistics and fails closed.

    The manifest becomes running totals over the calendar of each table, and a request two look-ups in
    them, at its last day and at the day before its first: equi-joins, however many requests there are.
    """
    span = manifest.groupBy("table_name").agg(
        F.min("dt").cast("date").alias("first_day"), F.max("dt").cast("date").alias("last_day")
    )
    days = span.select("table_name", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    days = days.select("table_name", F.col("day").cast("string").alias("dt"))
    per_day = manifest.groupBy("table_name", "dt").agg(F.sum("rows").alias("rows"))
    upto = Window.partitionBy("table_name").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    totals = days.join(per_day, ["table_name", "dt"], "left").select(
        "table_name",
        "dt",
        F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("rows"),
        F.count("rows").over(upto).alias("partitions"),
    )
    first, last = F.col("first_day").cast("string"), F.col("last_day").cast("string")
    asked = requests.join(span, "table_name", "left").select(
        "request_id",
        "table_name",
        F.col("first_day").isNotNull().alias("known"),
        F.least(F.coalesce("dt_to", last), last).alias("hi"),
        F.greatest(F.coalesce("dt_from", first), first).alias("lo"),
    )
    asked = asked.withColumn("before_lo", F.date_sub(F.col("lo").cast("date"), 1).cast("string"))

    def at(column: str, prefix: str) -> DataFrame:
        return totals.select(
            "table_name",
            F.col("dt").alias(column),
            F.col("rows").alias(f"{prefix}_rows"),
            F.col("partitions").alias(f"{prefix}_parts"),
        )

    found = asked.join(at("hi", "hi"), ["table_name", "hi"], "left").join(
        at("before_lo", "lo"), ["table_name", "before_lo"], "left"
    )
    zero = F.lit(0).cast("bigint")

    def between(kind: str):
        some = F.coalesce(f"hi_{kind}", zero) - F.coalesce(f"lo_{kind}", zero)
        return F.when(F.col("lo") <= F.col("hi"), some).otherwise(zero)

    verdict = (
        F.when(~F.col("known"), "unknown_statistics")
        .when(F.col("estimated_rows") > max_scan_rows, "over_limit")
        .otherwise("ok")
    )
    return (
        found.withColumns({"estimated_rows": between("rows"), "partitions": between("parts")})
        .withColumn("verdict", verdict)
        .select("request_id", "table_name", "estimated_rows", "partitions", "verdict")
    )


def latency_percentiles(
    df: DataFrame, value: str, by: list[str], percents: tuple[int, ...] = (50, 95, 99)
) -> DataFrame:
    """Exact percentiles per group: the value at position ``min(n - 1, floor(p * n / 100))`` of the
    sorted group. Integer arithmetic keeps the position exact."""
    n = F.col("n")
    positions = {f"p{p}": F.least(n - 1, F.call_function("div", n * p, F.lit(100))) for p in percents}
    return values_at(df, value, by, positions)


def bench_median(runs: DataFrame, value: str, run: str, by: list[str]) -> DataFrame:
    """Median and minimum per label over the runs after the warm-up, which is run 0."""
    n = F.col("n")
    middle = {
        "lower": F.call_function("div", n - 1, F.lit(2)),
        "upper": F.call_function("div", n, F.lit(2)),
        "least": F.lit(0),
    }
    found = values_at(runs.filter(F.col(run) > 0), value, by, middle)
    return found.select(
        *by,
        F.col("n").alias("runs"),
        ((F.col("lower") + F.col("upper")) / F.lit(2.0)).alias("median_value"),
        F.col("least").alias("min_value"),
    )
