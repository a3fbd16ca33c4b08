"""Cohorts kept up to date from bitmaps, next to the full rebuild over all payments."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag
from tidemark.operators import cohorts, curated
from tidemark.operators.ingest import Lake
from tidemark.sources import catalog
from tidemark.sources.lake import read_partitioned, write_partition_overwrite

START = datetime(2026, 3, 2)


def people(spark, n=300, seed=1, weeks=10):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(days=rng.randrange(7 * weeks), hours=rng.randrange(24))
        # Ids in several bitmap buckets.
        rows.append((i * 1000, "n", "p", "e", "v", "c", "k", at, at, at.date().isoformat()))
    return spark.createDataFrame(rows, catalog.struct_type("users"))


def payments(spark, n=3000, seed=2, days=80):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = START + timedelta(days=rng.randrange(days), hours=rng.randrange(24))
        payer = rng.choice([0, None, rng.randrange(320) * 1000])
        status = rng.choice(["SUCCESS", "FAILED", "PENDING"])
        rows.append((i, str(i), payer, 1, 100, status, None, at, at, at.date().isoformat()))
    return spark.createDataFrame(rows, catalog.struct_type("transactions"))


def expected(users, tx):
    return bag(curated.user_cohorts(users, tx))


def held(lake):
    columns = ("weeks_since_signup", "cohort_size", "active_users", "cohort_week")
    return bag(lake.curated("user_cohorts").select(*columns))


def test_full_run_equals_the_rebuild(spark, tmp_path):
    users, tx, lake = people(spark), payments(spark), Lake(spark, str(tmp_path))
    assert cohorts.refresh_cohorts(users, tx, lake) == (date(2026, 3, 2), date(2026, 5, 18))
    assert held(lake) == expected(users, tx)


def test_a_run_reads_every_user_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(user):
        read.add(1)
        return user

    users, tx, lake = people(spark), payments(spark), Lake(spark, str(tmp_path))
    seen = users.withColumn("user_id", counted("user_id"))
    cohorts.signup_bitmaps(seen).collect()
    once = read.value
    cohorts.refresh_cohorts(seen, tx, lake)
    assert once and read.value == 2 * once
    cohorts.refresh_cohorts(seen, tx, lake, date(2026, 5, 1), date(2026, 5, 8))
    assert read.value == 3 * once
    assert held(lake) == expected(users, tx)


def test_runs_over_eight_days_equal_the_rebuild(spark, tmp_path):
    users, tx, lake = people(spark), payments(spark), Lake(spark, str(tmp_path))
    cohorts.refresh_cohorts(users, tx.filter("dt < '2026-05-01'"), lake)
    for end in (date(2026, 5, 7), date(2026, 5, 14), date(2026, 5, 21)):
        first = end - timedelta(days=7)
        # Late updates: payments of the window change their status, and a whole day loses its successes.
        flips = (F.col("dt") >= first.isoformat()) & (F.col("dt") <= end.isoformat()) & (F.col("txn_id") % 3 == 0)
        tx = tx.withColumn("status", F.when(flips & (F.col("status") == "SUCCESS"), "FAILED").otherwise(F.col("status")))
        tx = tx.withColumn("status", F.when(F.col("dt") == end.isoformat(), "FAILED").otherwise(F.col("status")))
        seen = tx.filter(F.col("dt") <= end.isoformat())
        low, high = cohorts.refresh_cohorts(users, seen, lake, first, end)
        assert (low, high) == (first - timedelta(days=first.weekday()), end - timedelta(days=end.weekday()))
        assert held(lake) == expected(users, seen)


def test_new_and_moved_users_count_in_old_weeks(spark, tmp_path):
    users, tx, lake = people(spark), payments(spark), Lake(spark, str(tmp_path))
    cohorts.refresh_cohorts(users.filter("user_id % 7000 <> 0"), tx, lake)
    moved = users.withColumn(
        "created_at",
        F.when(F.col("user_id") == 5000, F.lit(datetime(2026, 3, 10)).cast("timestamp_ntz")).otherwise(F.col("created_at")),
    )
    low, _ = cohorts.refresh_cohorts(moved, tx, lake, date(2026, 5, 14), date(2026, 5, 21))
    assert low <= date(2026, 3, 16)
    assert held(lake) == expected(moved, tx)
    # Users that are gone take their activity along.
    fewer = moved.filter("user_id > 150000")
    cohorts.refresh_cohorts(fewer, tx, lake, date(2026, 5, 14), date(2026, 5, 21))
    assert held(lake) == expected(fewer, tx)


def test_a_run_reads_the_payments_of_its_days(spark, tmp_path, monkeypatch):
    users, lake = people(spark), Lake(spark, str(tmp_path / "lake"))
    write_partition_overwrite(payments(spark), str(tmp_path / "raw"))
    tx = read_partitioned(spark, str(tmp_path / "raw"), catalog.struct_type("transactions"))
    cohorts.refresh_cohorts(users, tx, lake)
    plans, store = [], cohorts.checkpointed
    monkeypatch.setattr(cohorts, "checkpointed", lambda df: (plans.append(df._jdf.queryExecution().toString()), store(df))[1])
    write = cohorts.write_partition_overwrite
    monkeypatch.setattr(
        cohorts, "write_partition_overwrite", lambda df, *a: (plans.append(df._jdf.queryExecution().toString()), write(df, *a))
    )
    cohorts.refresh_cohorts(users, tx, lake, date(2026, 5, 14), date(2026, 5, 21))
    # Payments are scanned once, for the day bitmaps, and only in the partitions of the range.
    scans = [line for p in plans for line in p.split("== Physical Plan ==")[1].splitlines() if "payer_user_id" in line and "FileScan" in line]
    assert len(scans) == 1
    assert ">= 2026-05-14" in scans[0] and "<= 2026-05-21" in scans[0]
    assert "PartitionFilters: [isnotnull(dt" in scans[0]


def test_no_month_of_a_long_range_is_left_out(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("2020-01-06", "c", 1, "2020-01")], cohorts.ACTIVITY)
    cohorts._replace(frame, path, "month")
    none = F.lit(False)
    cohorts._rewrite(frame.filter("false"), path, cohorts.ACTIVITY, date(2019, 12, 30), date(2026, 3, 2), none)
    months = sorted(r[0] for r in spark.read.schema(cohorts.ACTIVITY).parquet(path).select("month").collect())
    assert months == sorted({(date(2019, 12, 1) + timedelta(days=i)).isoformat()[:7] for i in range(2284)})


@pytest.mark.parametrize("given", [(None, None), (date(2026, 5, 14), date(2026, 5, 21))])
def test_without_payments_or_users(spark, tmp_path, given):
    users, tx, lake = people(spark), payments(spark), Lake(spark, str(tmp_path))
    assert cohorts.refresh_cohorts(users, tx.filter("false"), lake, *given) is None
    assert held(lake) == []
    cohorts.refresh_cohorts(users, tx, lake)
    assert held(lake) == expected(users, tx)
    cohorts.refresh_cohorts(users.filter("false"), tx, lake, *given)
    assert lake.curated("user_cohorts").count() == 0


def test_every_bitmap_moves_once(spark):
    """No row per week and cohort that carries their bitmaps."""
    rows = [(77 * (i % 700), datetime(2026, 1, 5) + timedelta(days=i % 150)) for i in range(3_000)]
    paid = spark.createDataFrame(rows, "payer_user_id bigint, created_at timestamp_ntz")
    paid = paid.select("payer_user_id", "created_at", F.lit("SUCCESS").alias("status"), F.col("created_at").cast("date").cast("string").alias("dt"))
    users = paid.groupBy(F.col("payer_user_id").alias("user_id")).agg(F.min("created_at").alias("created_at"))
    days, signups = cohorts.payer_days(paid), cohorts.signup_bitmaps(users)
    found = cohorts.week_activity(days, signups)
    expected = curated.user_cohorts(users, paid)
    assert bag(cohorts.cohorts_from_activity(found, signups)) == bag(expected) and found.count() > 10
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan and "Join" not in plan
