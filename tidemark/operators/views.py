"""The four analyst views, as functions and as temporary views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import percent, rupees


def daily_gmv(metrics: DataFrame) -> DataFrame:
    return (
        metrics.groupBy("dt")
        .agg(
            F.sum("txn_count").alias("txn_count"),
            F.sum("success_count").alias("success_count"),
            F.sum("success_amount_paise").alias("paise"),
        )
        .select(
            "dt",
            "txn_count",
            "success_count",
            rupees(F.col("paise")).alias("gmv_rupees"),
            percent(F.col("success_count"), F.col("txn_count")).alias("success_rate_pct"),
        )
    )


def merchant_leaderboard(metrics: DataFrame) -> DataFrame:
    return (
        metrics.groupBy("merchant_id", "merchant_name", "category")
        .agg(
            F.sum("txn_count").alias("txn_count"),
            F.sum("success_amount_paise").alias("paise"),
            F.sum("failed_count").alias("failed"),
            F.sum("refund_count").alias("refunded"),
            F.sum("success_count").alias("succeeded"),
        )
        .select(
            "merchant_id",
            "merchant_name",
            "category",
            "txn_count",
            rupees(F.col("paise")).alias("gmv_rupees"),
            percent(F.col("failed"), F.col("txn_count")).alias("failure_rate_pct"),
            percent(F.col("refunded"), F.col("succeeded")).alias("refund_rate_pct"),
        )
    )


def failure_reasons(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("status") == "FAILED")
        .groupBy("dt", "failure_code")
        .agg(F.count(F.lit(1)).alias("failed_count"))
    )


def retention_weekly(cohorts: DataFrame) -> DataFrame:
    return cohorts.select(
        "cohort_week",
        "weeks_since_signup",
        "cohort_size",
        percent(F.col("active_users"), F.col("cohort_size")).alias("retention_pct"),
    )


def register_views(metrics: DataFrame, transactions: DataFrame, cohorts: DataFrame) -> None:
    """Make the views available to SQL. They are inlined, so filters on ``dt`` reach the scans."""
    daily_gmv(metrics).createOrReplaceTempView("daily_gmv")
    merchant_leaderboard(metrics).createOrReplaceTempView("merchant_leaderboard")
    failure_reasons(transactions).createOrReplaceTempView("failure_reasons")
    retention_weekly(cohorts).createOrReplaceTempView("retention_weekly")
