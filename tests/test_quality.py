from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.helpers import bag, transactions
from tidemark.operators import quality, reconcile
from tidemark.operators.quality import DataQualityError
from tidemark.sources import catalog

DAY = "2026-08-21"
NOW = datetime(2026, 8, 24)


@pytest.fixture(scope="module")
def tx(spark):
    return transactions(spark).cache()


def verdict(tx, lake):
    found = quality.partition_gate(tx, lake, "transactions").filter(F.col("failed_check").isNotNull())
    return found, [(r["dt"], r["failed_check"]) for r in found.collect()]


def key_where(condition, value):
    return F.when((F.col("dt") == DAY) & condition, value).otherwise(F.col("txn_id"))


def test_good_partitions_pass(tx):
    found, failures = verdict(tx, tx)
    assert failures == []
    quality.gate(found)


def test_duplicates_fail_the_row_count_first(tx):
    found, failures = verdict(tx, tx.unionByName(tx.filter((F.col("dt") == DAY) & (F.col("txn_id") < 53))))
    assert failures == [(DAY, "row_count")]
    with pytest.raises(DataQualityError) as e:
        quality.gate(found)
    assert e.value.check == "row_count" and e.value.partition == DAY and "+3" in str(e.value)


def test_null_key_before_duplicate_key(tx):
    lake = tx.withColumn("txn_id", key_where(F.col("txn_id") == 60, F.lit(None)))
    found, failures = verdict(tx, lake)
    assert failures == [(DAY, "not_null")]
    assert found.first()["detail"] == "txn_id is missing in 1 of 50 rows"


def test_duplicate_key(tx):
    found, failures = verdict(tx, tx.withColumn("txn_id", key_where(F.col("txn_id") == 60, F.lit(61))))
    assert failures == [(DAY, "unique_key")]
    assert found.first()["detail"] == "txn_id repeats itself 1 times in 50 rows"


def test_missing_partition(tx):
    _, failures = verdict(tx, tx.filter(F.col("dt") != DAY))
    assert failures == [(DAY, "partition_exists")]


def test_null_foreign_key_names_its_column(tx):
    lake = tx.withColumn("merchant_id", F.when(F.col("txn_id") > 55, F.col("merchant_id")))
    found, _ = verdict(tx, lake)
    assert "merchant_id is missing in 50 of" in found.filter(F.col("dt") == "2026-08-20").first()["detail"]


def test_row_count_has_a_signed_difference(tx):
    short = tx.filter((F.col("dt") != DAY) | (F.col("txn_id") > 54))
    assert bag(quality.row_count(tx, short)) == [(DAY, 50, 45, -5)]
    quality.gate(quality.row_count_violations(quality.row_count(tx, tx), "transactions"))
    with pytest.raises(DataQualityError, match="in the lake 45: -5"):
        quality.gate(quality.row_count_violations(quality.row_count(tx, short), "transactions"))


def test_null_is_one_distinct_key(spark):
    df = spark.createDataFrame([("d", None), ("d", None), ("d", 1), ("e", None), ("e", 1)], "dt string, k int")
    assert bag(quality.unique_key(df, ["k"])) == [("d", 3, 2, 1)]


def test_not_null_counts_per_column(spark):
    df = spark.createDataFrame([("d", 1, None), ("d", None, None), ("e", 1, "x")], "dt string, a int, b string")
    assert bag(quality.not_null(df, ["a", "b"])) == [("d", 2, "a", 1), ("d", 2, "b", 2)]
    text = quality.not_null_violations(quality.not_null(df, ["b"]), "t").first()["detail"]
    assert text == "b is missing in 2 of 2 rows"


def test_expected_dates(spark):
    have = spark.createDataFrame([("2026-01-30",), ("2026-02-02",)], "dt string")
    assert bag(quality.partition_exists(quality.calendar(have), have)) == [("2026-01-31",), ("2026-02-01",)]


def fresh(spark, watermark, source_max, now):
    marks = spark.createDataFrame([("t", watermark)] if watermark else [], "table_name string, high_watermark timestamp_ntz")
    maxima = spark.createDataFrame([("t", source_max)], "table_name string, source_max_updated timestamp_ntz")
    return marks, maxima, quality.freshness(marks, maxima, now).first()["verdict"]


def test_freshness_limits_are_strict(spark):
    mark = datetime(2026, 9, 28)
    assert fresh(spark, mark, mark, datetime(2026, 9, 29, 2))[2] == "fresh"
    assert fresh(spark, mark, mark, datetime(2026, 9, 29, 2, 0, 0, 1))[2] == "watermark_behind_now"
    assert fresh(spark, mark, datetime(2026, 9, 29, 2, 0, 1), mark)[2] == "source_ahead_of_watermark"
    assert fresh(spark, None, mark, mark)[2] == "never_loaded"


def test_health_uses_the_rounded_lag(spark):
    mark = datetime(2026, 9, 28)
    now = datetime(2026, 9, 29, 2, 2)  # 26.03 hours: over the strict limit, 26.0 when rounded
    marks, maxima, verdict = fresh(spark, mark, mark, now)
    row = quality.freshness_status(marks, maxima, now).first()
    assert verdict == "watermark_behind_now" and (row["lag_hours"], row["status"]) == (26.0, "ok")


def test_schema_drift_reports_all_tables_at_once(spark):
    declared = quality.declared_columns(spark, ["transactions", "refunds"])
    live = declared.filter("NOT (table_name = 'transactions' AND column_name = 'status')")
    assert quality.schema_drift(declared, declared).count() == 0
    extra = spark.createDataFrame([("transactions", "device_id", "str")], live.schema)
    changed = live.withColumn(
        "family",
        F.when((F.col("table_name") == "refunds") & (F.col("column_name") == "amount_paise"), "float").otherwise(
            F.col("family")
        ),
    )
    drift = quality.schema_drift(changed.unionByName(extra), declared)
    assert bag(drift.select("table_name", "column_name", "drift")) == [
        ("refunds", "amount_paise", "type_changed"),
        ("transactions", "device_id", "added"),
        ("transactions", "status", "dropped"),
    ]
    with pytest.raises(DataQualityError) as e:
        quality.gate(quality.schema_drift_violations(drift))
    assert e.value.check == "schema_drift" and len(e.value.violations) == 3


def test_width_changes_are_not_drift(spark, tx):
    narrow = tx.drop("dt").withColumn("merchant_id", F.col("merchant_id").cast("int"))
    live = quality.schema_columns(spark, {"transactions": narrow.schema})
    assert quality.schema_drift(live, quality.declared_columns(spark, ["transactions"])).count() == 0


def test_reconcile_finds_lake_only_and_missing_partitions(spark, tx):
    manifest = spark.createDataFrame(
        [("2026-08-20", 50), ("2026-08-21", 49), ("2026-08-23", 50), ("2026-09-01", 7)], "dt string, rows bigint"
    )
    assert bag(reconcile.reconcile_counts(tx, manifest)) == [
        ("2026-08-21", 50, 49),
        ("2026-08-22", 50, None),
        ("2026-09-01", 0, 7),
    ]


def test_recent_reconciliation_looks_back_from_the_newest_date(tx):
    lake = tx.filter(~F.col("dt").isin("2026-08-20", "2026-08-22"))
    failed = reconcile.reconcile_recent(tx, lake, "transactions", lookback_days=2).filter("failed_check IS NOT NULL")
    assert [r["dt"] for r in failed.collect()] == ["2026-08-22"]
    everything = reconcile.reconcile_recent(tx, lake, "transactions").filter("failed_check IS NOT NULL")
    assert sorted(r["dt"] for r in everything.collect()) == ["2026-08-20", "2026-08-22"]


def compared(e, a):
    found = reconcile.compare_tables(e, a, ["dt", "merchant_id"], ["txn_count", "amount"]).collect()
    return {r["finding"]: r["row_count"] for r in found if r["row_count"]}


def test_comparison(spark):
    schema = "dt string, merchant_id int, txn_count int, amount int"
    rows = [("d", 1, 5, 10), ("d", 2, 6, None), ("e", 1, 7, 30)]
    base = spark.createDataFrame(rows, schema)
    assert compared(base, base) == {"matched": 3}
    assert compared(base, spark.createDataFrame([("d", 1, 5, 11), *rows[1:]], schema)) == {
        "matched": 3,
        "differs:amount": 1,
    }
    assert compared(base, base.filter("dt = 'd'")) == {"matched": 2, "only_in_source": 1}
    assert compared(base.filter("dt = 'd'"), base) == {"matched": 2, "only_in_lake": 1}


def test_report_has_a_row_per_table_and_check(spark):
    checks = spark.createDataFrame([("a", "row_count"), ("a", "not_null")], "table_name string, check_name string")
    bad = spark.createDataFrame(
        [("row_count", "a", "d", "x"), ("row_count", "a", "e", "y")],
        "check_name string, table_name string, dt string, detail string",
    )
    assert bag(quality.report(checks, bad)) == [("a", "not_null", "pass", "ok"), ("a", "row_count", "fail", "x")]


def test_families_go_by_class():
    kinds = {"decimal(18,0)": "float", "smallint": "int", "tinyint": "int", "varchar(10)": "str", "char(3)": "str", "float": "float"}
    for ddl, family in (kinds | {"timestamp": "ts", "timestamp_ntz": "ts", "binary": "binary"}).items():
        assert catalog.family(T.StructType.fromDDL(f"c {ddl}")["c"].dataType) == family, ddl


def test_latest_report_looks_at_the_newest_day_only(spark, tx):
    newest = tx.agg(F.max("dt")).first()[0]
    old_fault = tx.filter(~((F.col("dt") < newest) & (F.col("txn_id") % 7 == 0)))
    maxima = spark.createDataFrame([("transactions", NOW)], "table_name string, source_max_updated timestamp_ntz")
    marks = spark.createDataFrame([("transactions", NOW)], "table_name string, high_watermark timestamp_ntz")

    def status(lake, source=tx):
        out = quality.latest_report({"transactions": (source, lake)}, marks, maxima, NOW).collect()
        return {r["check_name"]: r["status"] for r in out if r["status"] != "pass"}

    assert status(old_fault) == {}
    assert status(tx.filter(F.col("dt") < newest)) == {"partition_exists": "fail"}
    assert status(tx.filter(F.col("txn_id") % 7 != 0)) == {"row_count": "fail"}
    assert status(tx, tx.withColumn("amount_paise", F.col("amount_paise").cast("double"))) == {"schema_drift": "fail"}
    assert set(status(tx.drop("txn_id")).values()) == {"error"}
