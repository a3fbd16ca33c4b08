"""The comparison by checksums of cells next to the plain outer comparison."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import refunds, transactions
from tidemark.operators import curated, reconcile
from tidemark.sources import catalog


@pytest.fixture(scope="module")
def tables(spark):
    tx = transactions(spark, days=12).withColumn("merchant_id", F.col("txn_id") % 11).cache()
    back = refunds(spark, tx).cache()
    shops = spark.createDataFrame([], catalog.struct_type("merchants"))
    metrics = curated.daily_merchant_metrics(tx, back, shops).cache()
    return tx, back, metrics


def found(df):
    return {r["finding"]: r["row_count"] for r in df.collect()}


def plain(tx, back, metrics):
    expected = reconcile.metrics_by_sql(tx, back)
    return found(reconcile.compare_tables(expected, metrics, reconcile.METRIC_KEYS, reconcile.METRIC_MEASURES))


def test_equal_tables_join_no_rows(tables, monkeypatch):
    def never(*a, **k):
        raise AssertionError("rows were compared")

    expected = plain(*tables)
    monkeypatch.setattr(reconcile, "compare_tables", never)
    monkeypatch.setattr(reconcile, "metrics_by_sql", never)
    assert found(reconcile.compare_metrics(*tables)) == expected
    assert expected["matched"] == tables[2].count() and sum(expected.values()) == expected["matched"]


def altered(metrics, kind):
    key = (F.col("dt") == "2026-08-23") & (F.col("merchant_id") == 4)
    if kind == "missing":
        return metrics.filter(~key)
    if kind == "extra":
        return metrics.unionByName(metrics.filter(key).withColumn("merchant_id", F.lit(99).cast("bigint")))
    if kind == "extra of zeros":
        none = {m: F.lit(0).cast("bigint") for m in reconcile.METRIC_MEASURES}
        return metrics.unionByName(metrics.filter(key).withColumn("merchant_id", F.lit(99).cast("bigint")).withColumns(none))
    if kind == "moved day":
        return metrics.withColumn("dt", F.when(key, "2030-01-01").otherwise(F.col("dt")))
    if kind == "null key":
        return metrics.withColumn("merchant_id", F.when(~key, F.col("merchant_id")))
    if kind == "swapped":
        # Two merchants of a day trade their values: all totals agree.
        other = F.when(F.col("merchant_id") == 4, 5).when(F.col("merchant_id") == 5, 4).otherwise(F.col("merchant_id"))
        return metrics.withColumn("merchant_id", F.when(F.col("dt") == "2026-08-23", other).otherwise(F.col("merchant_id")).cast("bigint"))
    if kind == "split":
        # One row as two that add up to it.
        one = metrics.filter(key)
        rest = {m: F.when(F.col(m) > 0, F.col(m) - 1).otherwise(0).cast("bigint") for m in reconcile.METRIC_MEASURES}
        first = {m: F.when(F.col(m) > 0, 1).otherwise(0).cast("bigint") for m in reconcile.METRIC_MEASURES}
        return metrics.filter(~key).unionByName(one.withColumns(rest)).unionByName(one.withColumns(first))
    name, _, what = kind.partition(" ")
    value = F.lit(None) if what == "null" else F.col(name) + (1 if what == "more" else -1)
    return metrics.withColumn(name, F.when(key, value).otherwise(F.col(name)).cast("bigint"))


KINDS = ["missing", "extra", "extra of zeros", "moved day", "null key", "swapped", "split", "txn_count null"]


@pytest.mark.parametrize("kind", KINDS + [f"{m} more" for m in reconcile.METRIC_MEASURES])
def test_every_difference_is_found(tables, kind):
    tx, back, metrics = tables
    changed = altered(metrics, kind)
    out, expected = found(reconcile.compare_metrics(tx, back, changed)), plain(tx, back, changed)
    assert out == expected
    assert sum(out.values()) > out["matched"] or kind == "split"


def test_many_differences_at_random(spark, tables):
    tx, back, metrics = tables
    rng = random.Random(5)
    for _ in range(3):
        p = rng.random() * 0.2
        some = F.pmod(F.xxhash64("dt", "merchant_id", F.lit(rng.random())), F.lit(1000)) < int(1000 * p)
        changed = metrics.withColumn("refund_amount_paise", F.when(some, F.col("refund_amount_paise") + 7).otherwise(F.col("refund_amount_paise")))
        assert found(reconcile.compare_metrics(tx, back, changed)) == plain(tx, back, changed)


def test_only_differing_cells_are_compared(tables, monkeypatch):
    tx, back, metrics = tables
    seen, real = [], reconcile.compare_tables
    monkeypatch.setattr(reconcile, "compare_tables", lambda e, a, *k: (seen.append((e.count(), a.count())), real(e, a, *k))[1])
    reconcile.compare_metrics(tx, back, altered(metrics, "txn_count more")).collect()
    assert seen[0][0] < metrics.count() / 10


def test_empty_sides(tables):
    tx, back, metrics = tables
    for a, b, c in ((tx.filter("false"), back, metrics), (tx, back, metrics.filter("false")), (tx.filter("false"), back, metrics.filter("false"))):
        assert found(reconcile.compare_metrics(a, b, c)) == plain(a, b, c)
