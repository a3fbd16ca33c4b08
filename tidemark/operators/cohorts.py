"""User cohorts kept up to date from bitmaps, so that a run reads the payments of its days only.

Three tables stand behind ``user_cohorts``:

- ``payer_days``: per day, who paid, as bitmaps of 32,768 users each. A run puts the days it covers in place of what they
  held, hence a payment that has lost its success disappears from them.
- ``signup_bitmaps``: per sign-up week, who joined.
- ``cohort_activity``: per week, how many of each sign-up week paid. A week is the union of its days, and the active users
  of a cohort are the bits it shares with it.

The first and the last are partitioned by the month in which a week begins, and rewritten in whole months: bitmaps and
counts, whose size depends on users and not on payments. A week is counted again if the run covers one of its days, or if a cohort that it can hold has gained or lost users.
"""

from __future__ import annotations

from datetime import date, timedelta
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import week_start
from tidemark.session import checkpointed, scratch_path, small_frame
from tidemark.sources.lake import write_partition_overwrite

if TYPE_CHECKING:
    from tidemark.operators.ingest import Lake

PAYER_DAYS = "dt string, bucket bigint, bits binary, week string, month string"
SIGNUPS = "cohort string, bucket bigint, bits binary"
ACTIVITY = "week string, cohort string, active_users bigint, month string"


def _bitmaps(df: DataFrame, by: str, user: str) -> DataFrame:
    """``by, bucket, bits``: the users of each value; a bit is set once however often its user occurs."""
    own = df.filter(F.col(user).isNotNull()).select(by, user).distinct()
    own = own.select(by, F.bitmap_bucket_number(user).alias("bucket"), F.bitmap_bit_position(user).alias("bit"))
    # Users move, 32,768 to a bitmap at most; bitmaps begun by every task would move with hardly a bit set in them.
    return own.repartition(by, "bucket").groupBy(by, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def payer_days(transactions: DataFrame) -> DataFrame:
    """``dt, bucket, bits, week, month``: who had a successful payment on each day."""
    paid = _bitmaps(transactions.filter(F.col("status") == "SUCCESS"), "dt", "payer_user_id")
    return _in_month(paid.withColumn("week", week_start("dt").cast("string")))


def _in_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.substring("week", 1, 7))


def signup_bitmaps(users: DataFrame) -> DataFrame:
    """``cohort, bucket, bits``: who signed up in each week."""
    return _bitmaps(users.withColumn("cohort", week_start("created_at").cast("string")), "cohort", "user_id")


def week_activity(days: DataFrame, signups: DataFrame) -> DataFrame:
    """``week, cohort, active_users`` from bitmaps, for weeks from the sign-up week on.

    Bitmaps meet by bucket, each sent there once: a group holds one bitmap per week and one per cohort, whatever the number
    of users, and pairs of them are intersected in place without listing a user.
    """
    weeks = (
        days.filter(F.col("bucket").isNotNull())
        .groupBy("week", "bucket")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
        .select("bucket", "week", "bits")
    )
    joined = signups.filter(F.col("bucket").isNotNull()).select("bucket", "cohort", "bits")
    both = weeks.groupBy("bucket").cogroup(joined.groupBy("bucket"))
    shared = both.applyInArrow(_shared_bits, "week string, cohort string, n bigint")
    return shared.groupBy("week", "cohort").agg(F.sum("n").alias("active_users")).filter("active_users > 0")


def _shared_bits(weeks: pa.Table, cohorts: pa.Table) -> pa.Table:
    """``week, cohort, n`` of one bucket: the bits that a week shares with each cohort up to it."""
    import numpy as np

    kind = pa.schema([("week", pa.string()), ("cohort", pa.string()), ("n", pa.int64())])
    if not (weeks.num_rows and cohorts.num_rows):
        return kind.empty_table()
    cohorts = cohorts.sort_by("cohort")
    names = cohorts["cohort"].to_numpy(zero_copy_only=False)
    joined = np.array([np.frombuffer(b, "u8") for b in cohorts["bits"].to_pylist()])
    found = []
    for week, bits in zip(weeks["week"].to_pylist(), weeks["bits"].to_pylist()):
        early = np.searchsorted(names, week, "right")
        n = np.bitwise_count(joined[:early] & np.frombuffer(bits, "u8")).sum(axis=1)
        found += [(week, names[i], int(n[i])) for i in np.flatnonzero(n)]
    return pa.Table.from_arrays([pa.array([r[i] for r in found], f.type) for i, f in enumerate(kind)], schema=kind)


def cohorts_from_activity(activity: DataFrame, signups: DataFrame) -> DataFrame:
    """The rows of ``user_cohorts``."""
    sizes = signups.groupBy("cohort").agg(F.sum(F.bitmap_count("bits")).alias("cohort_size"))
    offset = F.call_function("div", F.datediff(F.col("week").cast("date"), F.col("cohort").cast("date")), F.lit(7))
    return activity.join(sizes, "cohort").select(
        offset.cast("int").alias("weeks_since_signup"), "cohort_size", "active_users", F.col("cohort").alias("cohort_week")
    )


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def _once(df: DataFrame, name: str, schema: str) -> DataFrame:
    """``df`` written to the shared folder, for steps that would each derive it from the source again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def _monday(day: date) -> date:
    return day - timedelta(days=day.weekday())


def _between(column: str, first: date | str, last: date | str) -> Column:
    return F.col(column).between(str(first), str(last))


def refresh_cohorts(
    users: DataFrame, transactions: DataFrame, lake: Lake, first: date | None = None, last: date | None = None
) -> tuple[date, date] | None:
    """Bring ``user_cohorts`` up to date for payments of ``first`` to ``last``; return the weeks counted anew (Mondays).

    Payments outside of the range must be those that an earlier run has seen; without an earlier run, or without a range,
    all days are read and all tables replaced. Users are read once. Every step overwrites what it covers, and sign-ups are
    stored last: a run that broke off is repaired by running it again.
    """
    spark = lake.spark
    paths = {name: lake.curated_path(name) for name in ("payer_days", "signup_bitmaps", "cohort_activity", "user_cohorts")}
    before = _stored(spark, paths["signup_bitmaps"], SIGNUPS)
    known = first is not None and last is not None and before is not None
    if known:
        own = payer_days(transactions.filter(_between("dt", first, last)))
        _rewrite(own, paths["payer_days"], PAYER_DAYS, _monday(first), _monday(last), ~_between("dt", first, last))
    else:
        _replace(payer_days(transactions), paths["payer_days"], "month")
        _replace(small_frame(spark, [], ACTIVITY), paths["cohort_activity"], "month")

    signups, days = _once(signup_bitmaps(users), "signups", SIGNUPS), _stored(spark, paths["payer_days"], PAYER_DAYS)
    span = days.agg(F.min("week").cast("date").alias("a"), F.max("week").cast("date").alias("z")).first()
    counted = None
    if span["a"] is not None:
        low, high = (_monday(first), _monday(last)) if known else (span["a"], span["z"])
        if known:
            old = before.select("cohort", "bucket", F.col("bits").alias("old"))
            changed = signups.join(old, ["cohort", "bucket"], "full_outer").filter(~F.col("bits").eqNullSafe(F.col("old")))
            since = changed.agg(F.min("cohort").cast("date").alias("d")).first()["d"]
            if since is not None:
                low, high = min(low, since), max(high, span["z"])
        months = _between("month", low.isoformat()[:7], high.isoformat()[:7])
        fresh = _in_month(week_activity(days.filter(months & _between("week", low, high)), signups))
        _rewrite(fresh, paths["cohort_activity"], ACTIVITY, low, high, ~_between("week", low, high))
        counted = (low, high)
    activity = _stored(spark, paths["cohort_activity"], ACTIVITY).filter(F.col("cohort").isNotNull())
    _replace(cohorts_from_activity(activity, signups), paths["user_cohorts"], "cohort_week")
    _replace(signups, paths["signup_bitmaps"], "cohort")
    return counted


def _rewrite(own: DataFrame, path: str, schema: str, low: date, high: date, stays: Column) -> None:
    """Put ``own`` in place of the months from ``low`` to ``high``, next to those of their rows that stay.

    Every such month is written, with a row of nulls, so that one which has lost its last row is overwritten as well.
    """
    spark = own.sparkSession
    months = (low.replace(day=1) + timedelta(days=28 * i) for i in range((high - low).days // 28 + 3))
    months = sorted({m for m in (d.isoformat()[:7] for d in months) if m <= high.isoformat()[:7]})
    old = _stored(spark, path, schema).filter(F.col("month").isin(months) & F.col("week").isNotNull() & stays)
    none = small_frame(spark, [(m,) for m in months], "month string")
    # Checkpointed, since what is read is what will be overwritten.
    new = checkpointed(own.unionByName(old).unionByName(none, allowMissingColumns=True))
    write_partition_overwrite(new, path, "month", ["week"])


def _replace(df: DataFrame, path: str, partition: str) -> None:
    """The whole small table anew, so that values which have vanished go as well."""
    (
        df.hint("rebalance", F.col(partition))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .partitionBy(partition)
        .parquet(path)
    )
