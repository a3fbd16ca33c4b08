"""The six dashboard charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import mean
from tidemark.plans.frames import Frames


def total_gmv(f: Frames, since: str) -> DataFrame:
    return f.daily_gmv.filter(F.col("dt") >= since).agg(F.round(F.sum("gmv_rupees"), 2).alias("gmv"))


def daily_gmv(f: Frames, since: str) -> DataFrame:
    per_day = f.daily_gmv.filter(F.col("dt") >= since).groupBy("dt").agg(F.sum("gmv_rupees").alias("gmv"))
    return per_day.orderBy("dt")


def daily_success_rate(f: Frames, since: str) -> DataFrame:
    hundredths = F.round(F.col("success_rate_pct") * 100).cast("bigint")
    rate = mean(F.sum(hundredths), F.count(F.lit(1))) / F.lit(100.0)
    per_day = f.daily_gmv.filter(F.col("dt") >= since).groupBy("dt").agg(rate.alias("success_rate"))
    return per_day.orderBy("dt")


def top_merchants(f: Frames, row_limit: int = 10) -> DataFrame:
    columns = ["merchant_name", "category", "txn_count", "gmv_rupees", "failure_rate_pct", "refund_rate_pct"]
    return (
        f.merchant_leaderboard.select(*columns)
        .orderBy(F.col("gmv_rupees").desc(), "merchant_name")
        .limit(row_limit)
    )


def failure_codes(f: Frames, since: str) -> DataFrame:
    per_code = (
        f.failure_reasons.filter(F.col("dt") >= since)
        .groupBy("failure_code")
        .agg(F.sum("failed_count").alias("failed"))
    )
    return per_code.orderBy(F.col("failed").desc(), "failure_code")


def retention_cells(f: Frames) -> DataFrame:
    """All heat-map cells in long form."""
    cells = f.retention_weekly.groupBy("cohort_week", "weeks_since_signup").agg(
        F.max("retention_pct").alias("retention_pct")
    )
    return cells.orderBy("cohort_week", "weeks_since_signup")


def retention_heatmap(f: Frames, weeks: list[int]) -> DataFrame:
    """The same as a matrix: one row per cohort, one column per given week offset."""
    return (
        f.retention_weekly.groupBy("cohort_week")
        .pivot("weeks_since_signup", weeks)
        .agg(F.max("retention_pct"))
        .orderBy("cohort_week")
    )
