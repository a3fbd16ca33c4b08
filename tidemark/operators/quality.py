"""Data-quality checks. A check is a frame of violations, empty when all is well; :func:`gate` raises on rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import day
from tidemark.session import small_frame
from tidemark.sources import catalog

VIOLATION_COLUMNS = ["check_name", "table_name", "dt", "detail"]
MAX_LAG_HOURS = 26  # fixed value: freshness limit


class DataQualityError(Exception):
    """Carries the first violations and says which check failed, where, and with which numbers."""

    def __init__(self, violations: list[tuple[str, str, str | None, str]]):
        self.violations = violations
        self.check, self.table, self.partition, self.detail = violations[0]
        super().__init__(
            "; ".join(f"[{c}] {t}{f' dt={d}' if d else ''}: {detail}" for c, t, d, detail in violations)
        )


def gate(violations: DataFrame, report: int = 5) -> None:
    """Raise when there is any violation, naming the first few; all of them stay queryable in the frame."""
    name = "failed_check" if "failed_check" in violations.columns else "check_name"
    rows = violations.select(name, "table_name", "dt", "detail").orderBy("table_name", "dt").limit(report)
    found = [tuple(r) for r in rows.collect()]
    if found:
        raise DataQualityError(found)


def _violations(df: DataFrame, check: str, table: str, detail: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "dt", detail.alias("detail")
    )


def rows_per_day(source: DataFrame) -> DataFrame:
    return source.groupBy(day("created_at").alias("dt")).agg(F.count(F.lit(1)).alias("rows"))


def row_count(source: DataFrame, lake: DataFrame) -> DataFrame:
    """Partitions whose row counts differ, with the signed difference lake minus source.

    Both sides are aggregated to one row per day before they meet.
    """
    src = rows_per_day(source).withColumnRenamed("rows", "source_rows")
    lak = lake.groupBy("dt").agg(F.count(F.lit(1)).alias("lake_rows"))
    zero = F.lit(0).cast("bigint")
    both = src.join(lak, "dt", "full_outer").select(
        "dt",
        F.coalesce("source_rows", zero).alias("source_rows"),
        F.coalesce("lake_rows", zero).alias("lake_rows"),
    )
    return both.withColumn("diff", F.col("lake_rows") - F.col("source_rows")).filter(F.col("diff") != 0)


def row_count_violations(counts: DataFrame, table: str) -> DataFrame:
    detail = F.format_string(
        "rows at the source %d, in the lake %d: %+d", "source_rows", "lake_rows", "diff"
    )
    return _violations(counts, "row_count", table, detail)


def not_null(lake: DataFrame, columns: list[str]) -> DataFrame:
    """Null count of each given column per partition, in one pass over the table; zero counts left out."""
    counts = lake.groupBy("dt").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot(["dt", "rows"], columns, "column_name", "null_rows").filter(F.col("null_rows") > 0)


def not_null_violations(nulls: DataFrame, table: str) -> DataFrame:
    detail = F.format_string(
        "%s is missing in %d of %d rows", "column_name", "null_rows", "rows"
    )
    return _violations(nulls, "not_null", table, detail)


def unique_key(lake: DataFrame, keys: list[str], partition: str = "dt") -> DataFrame:
    """Partitions with repeated keys: rows minus distinct keys, NULL being one distinct key.

    Grouping by partition and key first lets copies of a hot key combine on the map side and spreads a
    hot partition over all tasks; the second grouping only adds up counts.
    """
    # Keys come out of the scan under their own names; a key named like the partition is not repeated.
    per_key = lake.groupBy(partition, *[k for k in keys if k != partition]).agg(
        F.count(F.lit(1)).alias("copies")
    )
    return (
        per_key.groupBy(partition)
        .agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"))
        .withColumn("duplicates", F.col("rows") - F.col("distinct_keys"))
        .filter(F.col("duplicates") > 0)
    )


def unique_key_violations(duplicates: DataFrame, table: str, key: str) -> DataFrame:
    detail = F.format_string(f"{key} repeats itself %d times in %d rows", "duplicates", "rows")
    return _violations(duplicates, "unique_key", table, detail)


def partition_exists(expected: DataFrame, manifest: DataFrame) -> DataFrame:
    """Expected dates the lake has no partition for."""
    return expected.select("dt").distinct().join(manifest.select("dt").distinct(), "dt", "left_anti")


def calendar(dates: DataFrame) -> DataFrame:
    """Every date from the first to the last ``dt``; at most one row per calendar day."""
    span = dates.agg(F.min("dt").cast("date").alias("lo"), F.max("dt").cast("date").alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.select(F.col("day").cast("string").alias("dt"))


def freshness(
    watermarks: DataFrame, source_max: DataFrame, now: datetime, max_lag_hours: int = MAX_LAG_HOURS
) -> DataFrame:
    """Verdict per table: never loaded, watermark too old, source too far ahead of it, or fresh.

    ``source_max`` has one row per table (``table_name, source_max_updated``). Limits are strict: a lag
    of exactly the limit is fresh. The order of the tests is the order of the verdicts.
    """
    at = F.lit(now).cast("timestamp_ntz")
    limit = F.make_dt_interval(hours=F.lit(max_lag_hours))
    wm, src = F.col("high_watermark"), F.col("source_max_updated")
    verdict = (
        F.when(wm.isNull(), "never_loaded")
        .when(at - wm > limit, "watermark_behind_now")
        .when(src - wm > limit, "source_ahead_of_watermark")
        .otherwise("fresh")
    )
    return source_max.join(watermarks.select("table_name", "high_watermark"), "table_name", "left").select(
        "table_name", "high_watermark", "source_max_updated", verdict.alias("verdict")
    )


def freshness_violations(verdicts: DataFrame) -> DataFrame:
    hour = "yyyy-MM-dd HH:mm"
    mark, ahead = F.date_format("high_watermark", hour), F.date_format("source_max_updated", hour)
    detail = (
        F.when(F.col("verdict") == "never_loaded", "nothing was loaded yet")
        .when(F.col("verdict") == "watermark_behind_now", F.concat(F.lit("last load reached "), mark))
        .otherwise(F.concat(F.lit("changes until "), ahead, F.lit(" were loaded until "), mark))
    )
    return verdicts.filter(F.col("verdict") != "fresh").select(
        F.lit("freshness").alias("check_name"),
        "table_name",
        F.lit(None).cast("string").alias("dt"),
        detail.alias("detail"),
    )


def freshness_status(
    watermarks: DataFrame, source_max: DataFrame, now: datetime, limit_hours: int = MAX_LAG_HOURS
) -> DataFrame:
    """Health row per table: lag in hours with one decimal, ``ok`` when that *rounded* lag is in the limit."""
    at = F.lit(now).cast("timestamp_ntz")
    lag_micros = F.timestamp_diff("MICROSECOND", F.col("high_watermark"), at)
    # Tenths of an hour, half up, on integers.
    tenth = 360_000_000
    lag = F.floor((lag_micros + tenth // 2) / tenth).cast("double") / F.lit(10.0)
    joined = source_max.join(watermarks.select("table_name", "high_watermark"), "table_name", "left")
    return joined.withColumn("lag_hours", lag).select(
        "table_name",
        "high_watermark",
        "source_max_updated",
        "lag_hours",
        F.when(F.col("lag_hours") <= limit_hours, "ok").otherwise("stale").alias("status"),
        F.lit(limit_hours).cast("bigint").alias("limit_hours"),
    )


def schema_columns(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    """``(table_name, column_name, family)`` of live schemas; schemas are driver metadata, not data."""
    rows = [
        (name, f.name, catalog.family(f.dataType))
        for name, schema in schemas.items()
        for f in schema.fields
    ]
    return small_frame(spark, rows, "table_name string, column_name string, family string")


def declared_columns(spark: SparkSession, tables: list[str]) -> DataFrame:
    rows = [
        (name, c.name, catalog.DECLARED_FAMILY[c.type])
        for name in tables
        for c in catalog.table(name).columns
        if c.name != "dt" or catalog.table(name).layer != "raw"
    ]
    return small_frame(spark, rows, "table_name string, column_name string, family string")


def schema_drift(live: DataFrame, declared: DataFrame) -> DataFrame:
    """Columns added, dropped or changed in type family, for all tables at once."""
    joined = live.withColumnRenamed("family", "live_family").join(
        declared.withColumnRenamed("family", "declared_family"), ["table_name", "column_name"], "full_outer"
    )
    drift = (
        F.when(F.col("declared_family").isNull(), "added")
        .when(F.col("live_family").isNull(), "dropped")
        .when(F.col("live_family") != F.col("declared_family"), "type_changed")
    )
    return joined.withColumn("drift", drift).filter(F.col("drift").isNotNull())


def schema_gate(source: DataFrame, table: str) -> list[tuple[str, str, None, str]]:
    """Violations of one live schema, from driver metadata alone: no job runs. The partition column may be there or not."""
    live = {f.name: catalog.family(f.dataType) for f in source.schema.fields if f.name != "dt"}
    declared = {c.name: catalog.DECLARED_FAMILY[c.type] for c in catalog.table(table).columns if c.name != "dt"}
    found = []
    for name in sorted(live.keys() | declared.keys()):
        if live.get(name) != declared.get(name):
            text = f"{name}: {declared.get(name, 'not declared')} expected, {live.get(name, 'no such column')} found"
            found.append(("schema_drift", table, None, text))
    return found


def schema_drift_violations(drift: DataFrame) -> DataFrame:
    detail = F.format_string(
        "%s: %s expected, %s found",
        "column_name",
        F.coalesce("declared_family", F.lit("not declared")),
        F.coalesce("live_family", F.lit("no such column")),
    )
    return drift.select(
        F.lit("schema_drift").alias("check_name"),
        "table_name",
        F.lit(None).cast("string").alias("dt"),
        detail.alias("detail"),
    )


def partition_gate(
    source: DataFrame, lake: DataFrame, table: str, expected: DataFrame | None = None
) -> DataFrame:
    """One row per expected date with its first failed check, or null when the partition is good.

    Checks in order: partition exists, row count, nulls in key columns, unique key. The lake is read
    once: grouping by date and key yields row, null and distinct-key counts together, and both a hot
    date and a hot key are spread or combined before the per-date totals.
    """
    spec = catalog.table(table)
    columns = spec.not_null_columns
    per_key = lake.groupBy("dt", F.col(spec.pk).alias("_key")).agg(
        F.count(F.lit(1)).alias("_copies"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in columns],
    )
    metrics = per_key.groupBy("dt").agg(
        F.sum("_copies").alias("lake_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in columns],
    )
    src = rows_per_day(source).withColumnRenamed("rows", "source_rows")
    if expected is None:
        dates = src
    else:
        dates = expected.select("dt").distinct().join(src, "dt", "left")
    joined = dates.join(metrics, "dt", "left")

    source_rows = F.coalesce("source_rows", F.lit(0).cast("bigint"))
    lake_rows, keys = F.col("lake_rows"), F.col("distinct_keys")
    null_detail, any_null = F.lit(None).cast("string"), F.lit(False)
    for c in reversed(columns):
        nulls = F.col(f"_null_{c}")
        text = F.format_string(f"{c} is missing in %d of %d rows", nulls, lake_rows)
        null_detail = F.when(nulls > 0, text).otherwise(null_detail)
        any_null = any_null | (nulls > 0)
    tests = [
        ("partition_exists", lake_rows.isNull(), F.lit("the lake has no such day")),
        (
            "row_count",
            source_rows != lake_rows,
            F.format_string(
                "rows at the source %d, in the lake %d: %+d",
                source_rows,
                lake_rows,
                lake_rows - source_rows,
            ),
        ),
        ("not_null", any_null, null_detail),
        (
            "unique_key",
            lake_rows != keys,
            F.format_string(
                f"{spec.pk} repeats itself %d times in %d rows", lake_rows - keys, lake_rows
            ),
        ),
    ]
    failed, detail = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, condition, text in reversed(tests):
        failed = F.when(condition, name).otherwise(failed)
        detail = F.when(condition, text).otherwise(detail)
    return joined.select(
        F.lit(table).alias("table_name"),
        "dt",
        source_rows.alias("source_rows"),
        F.coalesce(lake_rows, F.lit(0).cast("bigint")).alias("lake_rows"),
        failed.alias("failed_check"),
        detail.alias("detail"),
    )


def report(checks: DataFrame, violations: DataFrame) -> DataFrame:
    """Pass/fail row per table and check. ``checks`` lists what was run: ``(table_name, check_name)``."""
    failed = violations.groupBy("table_name", "check_name").agg(
        F.count(F.lit(1)).alias("violations"), F.min("detail").alias("message")
    )
    return checks.join(failed, ["table_name", "check_name"], "left").select(
        "table_name",
        "check_name",
        F.when(F.col("violations").isNull(), "pass").otherwise("fail").alias("status"),
        F.coalesce("message", F.lit("ok")).alias("message"),
    )


def latest_partition(df: DataFrame) -> DataFrame:
    """Rows of the newest ``dt``: a scalar maximum joined back, one row on the broadcast side."""
    newest = df.agg(F.max("dt").alias("dt"))
    return df.join(F.broadcast(newest), "dt", "left_semi")


CHECKS = ("schema_drift", "partition_exists", "row_count", "not_null", "unique_key", "freshness")


def latest_report(
    tables: dict[str, tuple[DataFrame, DataFrame]], watermarks: DataFrame, source_max: DataFrame, now: datetime
) -> DataFrame:
    """``table_name, check_name, status, message`` for every check on the newest day of every table.

    ``tables``: source and lake by name. The newest day is the source's, fetched as one row, so that both reads are pruned
    to it. Status ``error``: the check itself could not run; the message names the kind of failure and nothing of the data.
    Per table one verdict row comes to the driver.
    """
    spark = source_max.sparkSession
    stale = {r["table_name"]: r["detail"] for r in freshness_violations(freshness(watermarks, source_max, now)).collect()}
    rows = []
    for name, (source, lake) in tables.items():
        found: dict[str, str] = {}
        broken: str | None = None
        drift = schema_gate(source, name)
        try:
            newest = source.agg(F.max(day("created_at")).alias("dt")).first()["dt"]
            if newest is not None:
                start = F.lit(newest).cast("timestamp_ntz")
                recent = source.filter((F.col("created_at") >= start) & (F.col("created_at") < F.timestamp_add("DAY", F.lit(1), start)))
                expected = small_frame(spark, [(newest,)], "dt string")
                verdicts = partition_gate(recent, lake.filter(F.col("dt") == newest), name, expected).collect()
                found = {r["failed_check"]: r["detail"] for r in verdicts if r["failed_check"]}
        except PySparkException as error:
            broken = error.getCondition() or type(error).__name__
        for check in CHECKS:
            if check == "schema_drift":
                status, message = ("fail", "; ".join(d[3] for d in drift)) if drift else ("pass", "ok")
            elif check == "freshness":
                status, message = ("fail", stale[name]) if name in stale else ("pass", "ok")
            elif broken:
                status, message = "error", broken
            else:
                status, message = ("fail", found[check]) if check in found else ("pass", "ok")
            rows.append((name, check, status, message))
    return small_frame(spark, rows, "table_name string, check_name string, status string, message string")
