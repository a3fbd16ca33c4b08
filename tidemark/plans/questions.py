"""The analysts' ad-hoc questions, one function per query shape, dates and keys as parameters.

A result that answers several questions of one shape carries ``question_id``. Every top-k orders by its
measure and then by its key, so ties come out the same on every run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import mean, percent, rupees
from tidemark.plans.frames import Frames


def _stack(parts: dict[int, DataFrame]) -> DataFrame:
    tagged = [df.select(F.lit(i).cast("bigint").alias("question_id"), "*") for i, df in parts.items()]
    return reduce(DataFrame.unionByName, tagged)


def _dt(day: str) -> Column:
    return F.col("dt") == day


def _between(first: str, last: str, column: str = "dt") -> Column:
    return F.col(column).between(first, last)


def _counts(df: DataFrame, conditions: dict[int, Column], prune: Column | None = None) -> DataFrame:
    """Several filtered counts of one table in a single pass over the partitions any of them needs."""
    scoped = df if prune is None else df.filter(prune)
    totals = scoped.agg(*[F.count_if(c).alias(str(i)) for i, c in conditions.items()])
    long = totals.unpivot([], [F.col(str(i)) for i in conditions], "question_id", "n")
    return long.select(F.col("question_id").cast("bigint").alias("question_id"), "n")


def count_filter(
    f: Frames, day: str, other_day: str, last_day: str, signup_day: str, first: str, last: str
) -> DataFrame:
    status = F.col("status")
    parts = [
        _counts(
            f.transactions,
            {
                1: _dt(day),
                2: _dt(other_day) & (status == "FAILED"),
                26: _dt(last_day) & (status == "PENDING"),
                27: _dt(day) & (F.col("amount_paise") > 1_000_000),
            },
            F.col("dt").isin(day, other_day, last_day),
        ),
        _counts(f.merchants, {15: F.col("risk_tier") == "HIGH"}),
        _counts(f.refunds, {24: status == "PROCESSED"}, _dt(day)),
        _counts(
            f.users,
            {39: _dt(signup_day), 40: (F.col("kyc_status") == "FULL_KYC") & _between(first, last)},
            _dt(signup_day) | _between(first, last),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def view_point(f: Frames, day: str, cohort_week: str) -> DataFrame:
    cohort = f.retention_weekly.filter((F.col("cohort_week") == cohort_week) & (F.col("weeks_since_signup") == 1))
    return _stack(
        {
            3: f.daily_gmv.filter(_dt(day)).select(F.col("gmv_rupees").alias("value")),
            20: cohort.select(F.col("retention_pct").alias("value")),
        }
    )


def view_range_sorted(f: Frames, first: str, last: str, cohort_from: str, below_pct: int = 92) -> DataFrame:
    rates = f.daily_gmv.filter(_between(first, last)).select(
        F.col("dt").alias("key"), F.col("success_rate_pct").alias("value")
    )
    sizes = f.retention_weekly.filter((F.col("weeks_since_signup") == 0) & (F.col("cohort_week") >= cohort_from))
    found = _stack(
        {
            4: rates,
            22: sizes.select(F.col("cohort_week").alias("key"), F.col("cohort_size").cast("double").alias("value")),
            29: rates.filter(F.col("value") < below_pct),
        }
    )
    return found.orderBy("question_id", "key")


def _top(df: DataFrame, key: str, measure: str, k: int, name: str = "value") -> DataFrame:
    out = df.select(F.col(key).alias("key"), F.col(measure).alias(name))
    return out.orderBy(F.col(name).desc(), "key").limit(k)


def argmax(f: Frames, day: str, first: str, last: str, busy: int = 1000) -> DataFrame:
    failed = f.daily_merchant_metrics.filter(_dt(day)).withColumn("failed", F.col("failed_count").cast("double"))
    return _stack(
        {
            5: _top(f.daily_gmv.filter(_between(first, last)), "dt", "gmv_rupees", 1),
            18: _top(
                f.merchant_leaderboard.filter(F.col("txn_count") > busy), "merchant_name", "failure_rate_pct", 1
            ),
            36: _top(failed, "merchant_name", "failed", 1),
        }
    )


def topn_view(f: Frames, n: int = 5) -> DataFrame:
    return (
        f.merchant_leaderboard.select("merchant_name", "gmv_rupees")
        .orderBy(F.col("gmv_rupees").desc(), "merchant_name")
        .limit(n)
    )


def count_distinct(f: Frames, day: str) -> DataFrame:
    return f.daily_merchant_metrics.filter(_dt(day)).agg(F.count_distinct("merchant_id").alias("n"))


def range_sum(f: Frames, first: str, last: str, merchant_id: int) -> DataFrame:
    metrics = f.daily_merchant_metrics.filter(_between(first, last))
    one = metrics.filter(F.col("merchant_id") == merchant_id)
    gmv = f.daily_gmv.filter(_between(first, last))
    return _stack(
        {
            8: metrics.agg(rupees(F.sum("refund_amount_paise")).alias("value")),
            28: gmv.agg(F.round(F.sum("gmv_rupees"), 2).alias("value")),
            34: metrics.agg(F.sum("refund_count").cast("double").alias("value")),
            38: one.agg(rupees(F.sum("success_amount_paise")).alias("value")),
        }
    )


def view_point_sorted(f: Frames, day: str) -> DataFrame:
    return (
        f.failure_reasons.filter(_dt(day))
        .select("failure_code", "failed_count")
        .orderBy(F.col("failed_count").desc(), "failure_code")
    )


def group_top(f: Frames, first: str, last: str) -> DataFrame:
    metrics = f.daily_merchant_metrics.filter(_between(first, last))
    reasons = f.failure_reasons.filter(_between(first, last))

    def summed(df: DataFrame, key: str, measure: str, k: int) -> DataFrame:
        return _top(df.groupBy(key).agg(F.sum(measure).alias("n")), key, "n", k, "n")

    return _stack(
        {
            10: summed(reasons, "failure_code", "failed_count", 1),
            17: summed(metrics, "category", "failed_count", 3),
            19: summed(metrics, "merchant_name", "refund_count", 1),
        }
    )


def avg_filter(f: Frames, day: str, cohort_first: str, cohort_last: str) -> DataFrame:
    paid = f.transactions.filter(_dt(day) & (F.col("status") == "SUCCESS"))
    first_week = f.retention_weekly.filter(
        (F.col("weeks_since_signup") == 1) & _between(cohort_first, cohort_last, "cohort_week")
    )
    hundredths = F.round(F.col("retention_pct") * 100).cast("bigint")
    n = F.count(F.lit(1))
    return _stack(
        {
            11: paid.agg((mean(F.sum("amount_paise"), n) / F.lit(100.0)).alias("value")),
            21: first_week.agg((mean(F.sum(hundredths), n) / F.lit(100.0)).alias("value")),
        }
    )


def group_count(f: Frames, day: str, first: str, last: str) -> DataFrame:
    def counted(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))

    found = _stack(
        {
            12: counted(f.users, "city"),
            13: counted(f.users, "kyc_status"),
            14: counted(f.merchants, "category"),
            25: counted(f.refunds.filter(_between(first, last)), "reason"),
            37: counted(f.transactions.filter(_dt(day)), "status"),
        }
    )
    return found.orderBy("question_id", F.col("n").desc(), "key")


def group_sum_sorted(f: Frames, day: str) -> DataFrame:
    sums = f.daily_merchant_metrics.filter(_dt(day)).groupBy("category").agg(F.sum("success_amount_paise").alias("p"))
    return sums.select("category", rupees(F.col("p")).alias("gmv")).orderBy(F.col("gmv").desc(), "category")


def hour_histogram(f: Frames, day: str) -> DataFrame:
    hours = f.transactions.filter(_dt(day)).groupBy(F.hour("created_at").alias("h"))
    return hours.agg(F.count(F.lit(1)).alias("n")).orderBy("h")


def join_group(f: Frames, day: str) -> DataFrame:
    """Payments per category of one day. Counting per merchant first shrinks the join and evens it out."""
    per_merchant = f.transactions.filter(_dt(day)).groupBy("merchant_id").agg(F.count(F.lit(1)).alias("c"))
    joined = per_merchant.join(f.merchants.select("merchant_id", "category"), "merchant_id")
    return joined.groupBy("category").agg(F.sum("c").alias("n")).orderBy(F.col("n").desc(), "category")


def ratio_distinct(f: Frames, day: str) -> DataFrame:
    """Payments per paying user: counts per user, then their sum over their number."""
    per_user = f.transactions.filter(_dt(day)).groupBy("payer_user_id").agg(F.count(F.lit(1)).alias("c"))
    payers = F.count("payer_user_id")  # a missing payer adds payments, not a payer
    return per_user.agg(mean(F.sum("c"), payers).alias("avg_payments"))


def join_group_distinct(f: Frames, day: str) -> DataFrame:
    """Distinct payers per city. Payers are made distinct before the join; a payer has one city."""
    payers = f.transactions.filter(_dt(day)).select(F.col("payer_user_id").alias("user_id")).distinct()
    joined = payers.join(f.users.select("user_id", "city"), "user_id")
    return joined.groupBy("city").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "city")


def join_rate(f: Frames, day: str) -> DataFrame:
    per_merchant = (
        f.transactions.filter(_dt(day))
        .groupBy("merchant_id")
        .agg(F.count_if(F.col("status") == "SUCCESS").alias("ok"), F.count(F.lit(1)).alias("c"))
    )
    joined = per_merchant.join(f.merchants.select("merchant_id", "risk_tier"), "merchant_id")
    totals = joined.groupBy("risk_tier").agg(F.sum("ok").alias("ok"), F.sum("c").alias("c"))
    return totals.select("risk_tier", percent(F.col("ok"), F.col("c")).alias("success_rate"))


def max_filter(f: Frames, day: str) -> DataFrame:
    return f.transactions.filter(_dt(day)).agg(rupees(F.max("amount_paise")).alias("max_rupees"))


def category_day_gmv(f: Frames) -> DataFrame:
    """Successes and rupees per category and day over the whole fact table.

    Facts shrink to one row per merchant and day before they meet the merchants: what is shuffled and
    joined is that aggregate, whether or not the merchants fit a broadcast, and a dominant merchant is
    combined where its rows are read.
    """
    per_merchant = (
        f.transactions.filter(F.col("status") == "SUCCESS")
        .groupBy("merchant_id", F.col("created_at").cast("date").alias("d"))
        .agg(F.count(F.lit(1)).alias("c"), F.sum("amount_paise").alias("p"))
    )
    joined = per_merchant.join(f.merchants.select("merchant_id", "category"), "merchant_id")
    return joined.groupBy("category", "d").agg(F.sum("c").alias("n"), rupees(F.sum("p")).alias("gmv"))


def cte_block(f: Frames, days: list[str], first: str, n: int = 5) -> DataFrame:
    """A common table expression over filtered facts with an IN list, as analysts write it."""
    listed = ", ".join(f":d{i}" for i in range(len(days)))
    sql = f"""
        WITH per_merchant AS (
          SELECT merchant_id, sum(txn_count) AS n FROM {{metrics}} WHERE dt >= :first GROUP BY merchant_id),
        failed AS (
          SELECT merchant_id, count(*) AS failed FROM {{tx}}
          WHERE dt IN ({listed}) AND status = 'FAILED' GROUP BY merchant_id)
        SELECT p.merchant_id, p.n, coalesce(x.failed, 0) AS failed
        FROM per_merchant p LEFT JOIN failed x ON x.merchant_id = p.merchant_id
        ORDER BY p.n DESC, p.merchant_id LIMIT {int(n)}"""
    args = {f"d{i}": d for i, d in enumerate(days)} | {"first": first}
    spark = f.transactions.sparkSession
    return spark.sql(sql, args=args, metrics=f.daily_merchant_metrics, tx=f.transactions)


# Cost comparisons: the same totals over differently filtered or projected scans.


def scan_full(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count(F.lit(1)).alias("n"), F.sum("amount_paise").alias("paise"))


def scan_day(tx: DataFrame, day: str) -> DataFrame:
    return scan_full(tx.filter(_dt(day)))


def scan_week(tx: DataFrame, first: str, last: str) -> DataFrame:
    return scan_full(tx.filter(_between(first, last)))


def scan_nonpartition(tx: DataFrame, start: str, end: str) -> DataFrame:
    """A range on the creation time: no directory is pruned, row groups are skipped by their statistics."""
    created = F.col("created_at")
    bound = lambda v: F.lit(v).cast("timestamp_ntz")
    return scan_full(tx.filter((created >= bound(start)) & (created < bound(end))))


def select_star(tx: DataFrame, first: str, last: str) -> DataFrame:
    return tx.filter(_between(first, last))


def select_two(tx: DataFrame, first: str, last: str) -> DataFrame:
    return tx.filter(_between(first, last)).select("txn_id", "amount_paise")


def status_rollup(tx: DataFrame, first: str, last: str) -> DataFrame:
    return (
        tx.filter(_between(first, last))
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("amount_paise").alias("paise"))
    )
