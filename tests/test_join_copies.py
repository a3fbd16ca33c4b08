"""Bucketed copies of payments and refunds, and the metrics that join them without a shuffle."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, refunds, transactions
from tidemark.operators import curated
from tidemark.sources import catalog
from tidemark.sources.lake import read_partitioned


@pytest.fixture
def copies(spark, tmp_path):
    mark = uuid.uuid4().hex[:8]
    made = curated.JoinCopies(f"pay_{mark}", f"back_{mark}", str(tmp_path / "copies"), 4)
    yield made
    for name in (made.payments, made.refunds):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def shops(spark):
    rows = [(i, f"m{i}", "food", "x", "LOW", "1", None, None, "2026-08-20") for i in range(5)]
    return spark.createDataFrame(rows, catalog.struct_type("merchants"))


def shifted(back):
    """Refunds on later days than their payments, into the next month."""
    late = F.date_add(F.col("dt").cast("date"), (F.col("txn_id") % 20).cast("int"))
    return back.withColumn("dt", late.cast("string"))


def test_metrics_over_copies_equal_those_over_raw_tables(spark, tmp_path, copies, shops):
    tx = transactions(spark, days=14)
    back = shifted(refunds(spark, tx))
    curated.store_join_copies(tx, back, copies)
    out = curated.daily_merchant_metrics(tx, copies.given_back(spark), shops, "2026-08-24", "2026-09-01", copies.keys(spark))
    expected = curated.daily_merchant_metrics(tx, back, shops, "2026-08-24", "2026-09-01")
    assert bag(out) == bag(expected) and out.filter("refund_count > 0").count() > 0


def test_a_run_brings_its_months_up_to_date(spark, tmp_path, copies, shops):
    tx = transactions(spark, days=20)
    back = shifted(refunds(spark, tx))
    curated.store_join_copies(tx.filter("dt < '2026-09-03'"), back.filter("dt < '2026-09-03'"), copies)
    changed = back.withColumn("status", F.when(F.col("dt") >= "2026-09-01", "PENDING").otherwise(F.col("status")))
    end = date(2026, 9, 8)
    curated.store_join_copies(tx, changed, copies, "2026-09-01", "2026-09-08")
    path = str(tmp_path / "metrics")
    n = curated.transform_range(tx, changed, shops, path, end, copies=copies)
    stored = read_partitioned(spark, path, catalog.struct_type("daily_merchant_metrics"))
    expected = curated.daily_merchant_metrics(tx, changed, shops, "2026-09-01", "2026-09-08")
    assert n == expected.count() and bag(stored) == bag(expected)


def test_payments_and_refunds_meet_without_an_exchange(spark, tmp_path, copies, shops):
    tx = transactions(spark, days=4)
    curated.store_join_copies(tx, refunds(spark, tx), copies)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = curated.daily_merchant_metrics(tx, copies.given_back(spark), shops, "2026-08-20", "2026-08-22", copies.keys(spark))
        plan = out._jdf.queryExecution().sparkPlan().toString()
        ready = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [txn_id" in plan
    lines = ready.splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin [txn_id" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    below = []
    for line in lines[at + 1 :]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        below.append(line)
    assert sum("FileScan" in line for line in below) == 2
    assert not any("Exchange" in line for line in below)
    assert all("Bucketed: true" in line for line in below if "FileScan" in line)
    assert any("PartitionFilters" in line and "2026-08" in line for line in below)
