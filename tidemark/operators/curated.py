"""The two curated tables and the date range a transform run rebuilds."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import week_start
from tidemark.session import small_frame
from tidemark.sources import catalog
from tidemark.sources.lake import read_partitioned, write_bucketed, write_partition_overwrite

if TYPE_CHECKING:
    from tidemark.operators.ingest import Lake

LOOKBACK_DAYS = 7  # fixed value: late updates arrive within it


def refunds_per_txn(refunds: DataFrame) -> DataFrame:
    """Refunds that were not rejected, one row per payment, so that a join cannot multiply payments."""
    return (
        refunds.filter(F.col("status") != "REJECTED")
        .groupBy("txn_id")
        .agg(F.count(F.lit(1)).alias("refund_count"), F.sum("amount_paise").alias("refund_amount_paise"))
    )


def in_range(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Inclusive range on the text partition column; literals, so directories are pruned."""
    if start:
        df = df.filter(F.col("dt") >= start)
    if end:
        df = df.filter(F.col("dt") <= end)
    return df


def daily_merchant_metrics(
    transactions: DataFrame,
    refunds: DataFrame,
    merchants: DataFrame,
    start: str | None = None,
    end: str | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Counts, successful amount and refunds per payment day and merchant.

    Payments are counted straight from their scan and never join anything. Refunds count on the day of the payment they
    belong to, whatever their own date: only they meet the payments of the range, on ``txn_id``, which is unique there and
    therefore even. Both sums are then added up per day and merchant, and names are joined to that aggregate. A merchant that
    owns a third of the payments is combined on the map side.

    ``keys`` may hold ``txn_id, dt, merchant_id`` of the payments a second time, laid out for the join with ``refunds``
    (:func:`store_join_copies`).
    """
    tx = in_range(transactions, start, end).select("txn_id", "dt", "merchant_id", "status", "amount_paise")
    ok = F.col("status") == "SUCCESS"
    zero = F.lit(0).cast("bigint")
    counts = {
        "txn_count": F.count(F.lit(1)),
        "success_count": F.count_if(ok),
        "failed_count": F.count_if(F.col("status") == "FAILED"),
        "pending_count": F.count_if(F.col("status") == "PENDING"),
        "success_amount_paise": F.coalesce(F.sum(F.when(ok, F.col("amount_paise"))), zero),
    }
    returns = {"refund_count": F.count(F.lit(1)), "refund_amount_paise": F.coalesce(F.sum("refunded"), zero)}
    paid = tx.groupBy("dt", "merchant_id").agg(*(c.alias(n) for n, c in counts.items()))
    given_back = refunds.filter(F.col("status") != "REJECTED").select("txn_id", F.col("amount_paise").alias("refunded"))
    given_back = (
        (tx if keys is None else in_months(in_range(keys, start, end), start, end))
        .select("txn_id", "dt", "merchant_id")
        .join(given_back, "txn_id")
        .groupBy("dt", "merchant_id")
        .agg(*(c.alias(n) for n, c in returns.items()))
    )
    measures = [*counts, *returns]
    totals = (
        paid.unionByName(given_back, allowMissingColumns=True)
        .groupBy("dt", "merchant_id")
        .agg(*(F.coalesce(F.sum(m), zero).alias(m) for m in measures))
    )
    names = merchants.select("merchant_id", "merchant_name", "category")
    return totals.join(names, "merchant_id", "left").select(
        "merchant_id", "merchant_name", "category", *measures, "dt"
    )


def in_months(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Inclusive range of days on the ``month`` partition of a join copy."""
    df = df.filter(F.col("month") >= start[:7]) if start else df
    return df.filter(F.col("month") <= end[:7]) if end else df


@dataclass(frozen=True)
class JoinCopies:
    """Catalog tables with the columns that payments and refunds meet on, bucketed and sorted by payment.

    Partitions are months of the rows' own ``dt``, so that a bucket is not cut into a file per day.
    """

    payments: str
    refunds: str
    root: str
    buckets: int

    def keys(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.payments)

    def given_back(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.refunds)


def store_join_copies(
    transactions: DataFrame, refunds: DataFrame, copies: JoinCopies, start: str | None = None, end: str | None = None
) -> None:
    """Bring the copies up to date for days ``start`` to ``end`` of either table: their months are written anew."""
    for df, name, columns in (
        (transactions, copies.payments, ("txn_id", "merchant_id", "dt")),
        (refunds, copies.refunds, ("txn_id", "amount_paise", "status", "dt")),
    ):
        df = df.filter(F.col("dt") >= f"{start[:7]}-01") if start else df
        df = df.filter(F.col("dt") <= f"{end[:7]}-31") if end else df
        month = F.substring("dt", 1, 7).alias("month")
        write_bucketed(df.select(*columns, month), name, f"{copies.root}/{name}", "txn_id", copies.buckets, "month")


def user_cohorts(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Cohort size and active payers per sign-up week and whole weeks since sign-up.

    Payments shrink to distinct (payer, week) before the join, on the map side, so a payer with a third
    of all payments contributes a handful of rows. A user has one sign-up week, hence counting those
    rows counts distinct payers. Weeks before sign-up are dropped, as are cohorts without activity.
    """
    signup = users.select("user_id", week_start("created_at").alias("cohort"))
    sizes = signup.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    active = (
        transactions.filter(F.col("status") == "SUCCESS")
        .select(F.col("payer_user_id").alias("user_id"), week_start("created_at").alias("week"))
        .distinct()
    )
    offset = F.call_function("div", F.datediff("week", "cohort"), F.lit(7)).cast("int")
    activity = (
        active.join(signup, "user_id")
        .filter(F.col("week") >= F.col("cohort"))
        .groupBy("cohort", offset.alias("weeks_since_signup"))
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    return activity.join(sizes, "cohort").select(
        "weeks_since_signup", "cohort_size", "active_users", F.col("cohort").cast("string").alias("cohort_week")
    )


def transform_window(end: date, start: date | None = None) -> tuple[str, str]:
    """Inclusive partition range of a transform run: seven days back from ``end`` unless told otherwise."""
    return (start or end - timedelta(days=LOOKBACK_DAYS)).isoformat(), end.isoformat()


def transform_range(
    transactions: DataFrame,
    refunds: DataFrame,
    merchants: DataFrame,
    path: str,
    end: date,
    start: date | None = None,
    copies: JoinCopies | None = None,
) -> int:
    """Rebuild the metric partitions of the range in place; return the rows the range holds afterwards.

    With ``copies``, kept up to date by :func:`store_join_copies`, neither payments nor refunds are shuffled to meet. Rows
    are counted from the footers of the written files, not by running the plan a second time.
    """
    first, last = transform_window(end, start)
    spark = transactions.sparkSession
    if copies:
        metrics = daily_merchant_metrics(
            transactions, copies.given_back(spark), merchants, first, last, copies.keys(spark)
        )
    else:
        metrics = daily_merchant_metrics(transactions, refunds, merchants, first, last)
    write_partition_overwrite(metrics, path, "dt", ["merchant_id"])
    schema = catalog.struct_type("daily_merchant_metrics")
    try:
        return in_range(read_partitioned(spark, path, schema), first, last).count()
    except AnalysisException as error:  # nothing was ever written there
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 0


def write_cohorts(users: DataFrame, transactions: DataFrame, path: str) -> None:
    """Rebuild the cohort table in place, one partition per sign-up week."""
    write_partition_overwrite(user_cohorts(users, transactions), path, "cohort_week", ["weeks_since_signup"])


class CuratedError(Exception):
    """A curated table does not agree with its source."""


def transform(
    users: DataFrame,
    merchants: DataFrame,
    transactions: DataFrame,
    refunds: DataFrame,
    lake: Lake,
    end: date,
    start: date | None = None,
    register: str | None = None,
) -> DataFrame:
    """One run over both curated tables: write, compare with the source, save statistics, register.

    Metrics are rebuilt for the range, and so is what the range adds to the cohorts (all days on the first run, see
    :mod:`tidemark.operators.cohorts`). Both are then read back and compared, in the range and in the weeks counted anew, with
    independent formulations; a difference raises :class:`CuratedError` before statistics or catalog say anything
    about the run. ``register`` names a database to (re-)attach the tables in. Returns the findings.
    """
    from tidemark.operators import reconcile
    from tidemark.operators.cohorts import refresh_cohorts
    from tidemark.operators.ingest import partition_manifest
    from tidemark.sources.lake import register_external_table

    first, last = transform_window(end, start)
    transform_range(transactions, refunds, merchants, lake.curated_path("daily_merchant_metrics"), end, start)
    weeks = refresh_cohorts(users, transactions, lake, date.fromisoformat(first), date.fromisoformat(last))
    stored = {name: lake.curated(name) for name in ("daily_merchant_metrics", "user_cohorts")}
    metrics = in_range(stored["daily_merchant_metrics"], first, last)
    low, high = weeks or (date.max, date.min)
    paid_in = F.date_add(F.col("cohort_week").cast("date"), F.col("weeks_since_signup") * 7)
    findings = reconcile.curated_vs_source(
        users,
        in_range(transactions, first, last),
        in_range(transactions, low.isoformat(), (high + timedelta(days=6)).isoformat()) if weeks else transactions.limit(0),
        refunds,
        metrics,
        stored["user_cohorts"].filter(paid_in.between(low, high)),
    )
    # A dozen rows, one per kind of finding.
    rows = findings.collect()
    wrong = {(r["table_name"], r["finding"]): r["row_count"] for r in rows if r["finding"] != "matched" and r["row_count"]}
    if wrong:
        raise CuratedError(f"curated tables differ from their source: {wrong}")
    for name, frame in stored.items():
        partition = catalog.table(name).partition_column
        touched = metrics if name == "daily_merchant_metrics" else frame
        lake.save_manifest(partition_manifest(touched, name, partition=partition))
        if register:
            # Partition values of the run: bounded by the days of its range.
            values = [r[0] for r in touched.select(partition).distinct().collect()] if name != "user_cohorts" else None
            register_external_table(
                lake.spark, f"{register}.{name}", lake.curated_path(name), catalog.struct_type(name), partition, touched=values
            )
    return small_frame(lake.spark, [tuple(r) for r in rows], "table_name string, finding string, row_count bigint")
