import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag, transactions
from tidemark.operators import ingest, reconcile
from tidemark.operators.quality import DataQualityError
from tidemark.sources import catalog, lake
from tidemark.streaming.change_feed import follow_changes

TX = catalog.struct_type("transactions")
DAY0 = datetime(2026, 8, 20)


def files(path):
    return {
        d: sorted(f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet"))
        for d in os.listdir(path)
        if d.startswith("dt=")
    }


def test_changed_partitions_surface_old_dates(spark):
    tx = transactions(spark)
    # On day 2 the rows created that day changed, and late ones of day 0.
    found = ingest.changed_partitions(tx, DAY0 + timedelta(days=2), DAY0 + timedelta(days=3))
    assert bag(found) == [("2026-08-20",), ("2026-08-22",)]


def test_window_is_half_open(spark):
    tx = transactions(spark, days=1, per_day=1).withColumn("updated_at", F.lit(DAY0).cast("timestamp_ntz"))
    before = ingest.changed_partitions(tx, DAY0 - timedelta(days=1), DAY0)
    at = ingest.changed_partitions(tx, DAY0, DAY0 + timedelta(seconds=1))
    assert before.count() == 0 and at.count() == 1


def test_rebuild_takes_unchanged_rows_too(spark):
    tx = transactions(spark)
    changed = spark.createDataFrame([("2026-08-20",), ("2026-08-20",)], "dt string")
    rebuilt = ingest.rebuild_partitions(tx, changed, "transactions")
    assert rebuilt.count() == 50 and rebuilt.columns == TX.fieldNames()
    plan = rebuilt._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_overwrite_touches_only_its_partitions_and_is_idempotent(spark, tmp_path):
    tx, path = transactions(spark), str(tmp_path / "t")
    lake.write_partition_overwrite(tx, path, "dt", ["txn_id"])
    first = files(path)
    assert len(first) == 4 and all(len(f) == 1 for f in first.values())
    one = tx.filter(F.col("dt") == "2026-08-21")
    for _ in range(2):
        lake.write_partition_overwrite(one, path, "dt", ["txn_id"])
    second = files(path)
    assert {d for d in first if first[d] != second[d]} == {"dt=2026-08-21"}
    assert bag(lake.read_partitioned(spark, path, TX)) == bag(tx)


def test_partition_column_stays_text_without_a_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_partition_overwrite(transactions(spark), path)
    assert lake.read_partitioned(spark, path).schema["dt"].dataType.simpleString() == "string"


def test_a_hot_partition_is_not_written_by_one_task(spark, tmp_path):
    """Two thirds of the rows on one day: that day is split, the others stay whole."""
    other = F.concat(F.lit("2026-09-0"), F.col("id") % 5 + 1)
    df = spark.range(0, 120_000, 1, 6).select(
        F.col("id").alias("txn_id"),
        F.when(F.col("id") % 3 > 0, "2026-08-01").otherwise(other).alias("dt"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        lake.write_partition_overwrite(df, str(tmp_path / "t"), "dt", ["txn_id"])
    finally:
        spark.conf.set(key, before)
    layout = files(str(tmp_path / "t"))
    assert len(layout["dt=2026-08-01"]) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 120_000


def test_manifest_hash_sees_every_kind_of_change(spark):
    tx = transactions(spark, days=1)
    base = ingest.content_manifest(tx, "t")

    def changes(df):
        return [r["change"] for r in ingest.manifest_diff(base, ingest.content_manifest(df, "t")).collect()]

    assert changes(tx.repartition(3)) == []
    pair = tx.unionByName(tx.filter("txn_id = 1")).filter("txn_id <> 2")
    assert changes(pair) == ["changed"]  # same number of rows
    twice = tx.filter("txn_id > 1").unionByName(tx.filter("txn_id = 5")).unionByName(tx.filter("txn_id = 5"))
    assert changes(twice) == ["changed"]  # a pair cancels in an xor
    swapped = tx.withColumn("payer_user_id", F.when(F.col("txn_id") == 3, None).otherwise(F.col("payer_user_id")))
    assert changes(swapped) == ["changed"]
    assert changes(tx.withColumn("dt", F.lit("2026-08-25"))) in (["removed", "added"], ["added", "removed"])


def test_watermark_never_moves_back(spark):
    schema = ingest.WATERMARK_SCHEMA
    now = spark.createDataFrame([("a", datetime(2026, 9, 5), "r1"), ("b", datetime(2026, 9, 1), "r1")], schema)
    new = spark.createDataFrame([("a", datetime(2026, 9, 2), "r2"), ("c", datetime(2026, 9, 3), "r2")], schema)
    assert bag(ingest.advance_watermark(now, new)) == [
        ("a", datetime(2026, 9, 5), "r2"),
        ("b", datetime(2026, 9, 1), "r1"),
        ("c", datetime(2026, 9, 3), "r2"),
    ]


def test_extract_twice_changes_nothing(spark, tmp_path):
    tx, target = transactions(spark), ingest.Lake(spark, str(tmp_path))
    lo, hi = ingest.EPOCH, DAY0 + timedelta(days=30)
    first = bag(ingest.incremental_extract(tx, "transactions", target, lo, hi, "a").select("dt", "rows", "content_hash"))
    second = bag(ingest.incremental_extract(tx, "transactions", target, lo, hi, "b").select("dt", "rows", "content_hash"))
    assert first == second and [r[1] for r in first] == [50] * 4
    assert bag(target.raw("transactions")) == bag(tx)
    mark = target.watermarks().collect()
    assert [(r.table_name, r.high_watermark, r.last_run_id) for r in mark] == [("transactions", hi, "b")]


def test_only_partitions_leaves_the_watermark_alone(spark, tmp_path):
    tx, target = transactions(spark), ingest.Lake(spark, str(tmp_path))
    out = ingest.incremental_extract(
        tx, "transactions", target, DAY0, DAY0 + timedelta(days=1), only_partitions=["2026-08-22"]
    )
    assert [r.dt for r in out.collect()] == ["2026-08-22"]
    assert target.watermarks().count() == 0


def test_empty_window_advances_the_watermark_only(spark, tmp_path):
    tx, target = transactions(spark), ingest.Lake(spark, str(tmp_path))
    hi = datetime(2030, 1, 2)
    out = ingest.incremental_extract(tx, "transactions", target, datetime(2030, 1, 1), hi)
    assert out.count() == 0 and target.watermarks().first()["high_watermark"] == hi


def test_bad_rows_stop_the_run_before_the_watermark_moves(spark, tmp_path):
    tx = transactions(spark).withColumn("merchant_id", F.when(F.col("txn_id") != 7, F.col("merchant_id")))
    target = ingest.Lake(spark, str(tmp_path))
    with pytest.raises(DataQualityError) as e:
        ingest.incremental_extract(tx, "transactions", target, ingest.EPOCH, datetime(2030, 1, 1))
    assert e.value.check == "not_null" and "merchant_id" in str(e.value)
    assert target.watermarks().count() == 0


def test_drill_rows_older_than_the_window_are_found_by_reconciliation(spark, tmp_path):
    tx, target = transactions(spark), ingest.Lake(spark, str(tmp_path))
    hi = DAY0 + timedelta(days=30)
    ingest.incremental_extract(tx, "transactions", target, ingest.EPOCH, hi)
    late = tx.filter("dt = '2026-08-21'").limit(25).withColumn("txn_id", F.col("txn_id") + 9000)
    grown = tx.unionByName(late)
    ingest.incremental_extract(grown, "transactions", target, hi, hi + timedelta(days=1))
    bad = bag(reconcile.reconcile_counts(grown, target.manifest("transactions")))
    assert bad == [("2026-08-21", 75, 50)]
    ingest.incremental_extract(grown, "transactions", target, hi, hi, only_partitions=["2026-08-21"])
    assert reconcile.reconcile_counts(grown, target.manifest("transactions")).count() == 0


def test_compaction_keeps_rows(spark, tmp_path):
    tx = transactions(spark)
    small, target = str(tmp_path / "s"), str(tmp_path / "c")
    lake.split_partitions(tx, small, 6, F.pmod("txn_id", F.lit(6)))
    assert all(len(f) == 6 for f in files(small).values())
    compacted = lake.compact_partitions(spark, small, target, TX)
    assert all(len(f) == 1 for f in files(target).values()) and bag(compacted) == bag(tx)


def test_partition_filter_prunes_and_columns_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_partition_overwrite(transactions(spark), path)
    df = lake.read_partitioned(spark, path, TX).filter(F.col("dt") == "2026-08-21").select("txn_id", "amount_paise")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "ReadSchema: struct<txn_id:bigint,amount_paise:bigint>" in plan
    profile = {
        r["variant"]: r
        for r in lake.scan_profile(
            {"all": lake.read_partitioned(spark, path, TX), "day": lake.read_partitioned(spark, path, TX).filter("dt = '2026-08-21'")}
        ).collect()
    }
    assert (profile["all"]["files"], profile["day"]["files"]) == (4, 1)
    assert profile["all"]["bytes"] > profile["day"]["bytes"] > 0


def test_stream_of_changes_rebuilds_the_touched_partitions(spark, tmp_path):
    tx = transactions(spark)
    changes = str(tmp_path / "changes")
    tx.filter("dt = '2026-08-20' AND txn_id % 10 = 0").select("created_at", "updated_at").write.parquet(changes)
    target = ingest.Lake(spark, str(tmp_path / "lake"))
    feed = spark.readStream.schema("created_at timestamp_ntz, updated_at timestamp_ntz").parquet(changes)
    for _ in range(2):
        follow_changes(feed, lambda: tx, "transactions", target, str(tmp_path / "cp")).awaitTermination()
    assert bag(target.raw("transactions")) == bag(tx.filter("dt = '2026-08-20'"))
    assert target.watermarks().first()["high_watermark"] == datetime(2026, 8, 22, 0, 40)


def test_external_table_counts_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_partition_overwrite(transactions(spark, days=3), path)
    name = "ext_" + tmp_path.name.replace("-", "_")
    assert lake.register_external_table(spark, name, path, TX) == 3
    lake.write_partition_overwrite(transactions(spark, days=4), path)
    assert lake.register_external_table(spark, name, path, TX, touched=["2026-08-23"]) == 4
    assert spark.table(name).count() == 200
    with pytest.raises(ValueError, match="registered at"):
        lake.register_external_table(spark, name, path + "2", TX)
    with pytest.raises(ValueError, match="other columns"):
        lake.register_external_table(spark, name, path, catalog.struct_type("refunds"))
    spark.sql(f"DROP TABLE {name}")


def test_drift_stops_the_run_before_a_write(spark, tmp_path):
    tx, lake = transactions(spark), ingest.Lake(spark, str(tmp_path))
    for drifted in (tx.withColumn("amount_paise", F.col("amount_paise").cast("double")), tx.withColumn("note", F.lit("x"))):
        with pytest.raises(DataQualityError, match="schema_drift"):
            ingest.incremental_extract(drifted, "transactions", lake, ingest.EPOCH, DAY0 + timedelta(days=9))
    assert os.listdir(tmp_path) == []


def test_rows_without_a_creation_time_are_reported(spark, tmp_path):
    tx, lake = transactions(spark), ingest.Lake(spark, str(tmp_path))
    bad = tx.withColumn("created_at", F.when(F.col("txn_id") != 5, F.col("created_at")))
    with pytest.raises(DataQualityError, match="created_at"):
        ingest.incremental_extract(bad, "transactions", lake, ingest.EPOCH, DAY0 + timedelta(days=9))


def test_a_late_row_adds_an_interval_and_not_the_years_between():
    days = [f"2026-08-{d:02d}" for d in (20, 21, 22)]
    assert ingest.intervals(["2023-01-05", *days]) == [
        (datetime(2023, 1, 5), datetime(2023, 1, 5)),
        (datetime(2026, 8, 20), datetime(2026, 8, 22)),
    ]
    many = [(datetime(2020, 1, 1) + timedelta(days=2 * i)).date().isoformat() for i in range(500)]
    merged = ingest.intervals(many)
    assert len(merged) == ingest.MAX_INTERVALS
    assert all(any(a <= datetime.fromisoformat(d) <= b for a, b in merged) for d in many)


def test_intervals_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "source")
    tx = transactions(spark)
    old = tx.limit(1).withColumn("created_at", F.lit(datetime(2023, 1, 5)).cast("timestamp_ntz"))
    tx.unionByName(old.withColumn("txn_id", F.lit(99_999).cast("bigint"))).write.parquet(path)
    source, seen = spark.read.parquet(path), []
    lake = ingest.Lake(spark, str(tmp_path / "lake"))
    real = ingest.snapshot
    ingest.snapshot = lambda s, name: seen.append(s) or real(s, name)
    try:
        ingest.incremental_extract(source, "transactions", lake, ingest.EPOCH, DAY0 + timedelta(days=9))
    finally:
        ingest.snapshot = real
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "Or(And(" in pushed and "2023-01-06" in pushed  # the first interval ends there
    assert lake.raw("transactions").filter("dt = '2023-01-05'").count() == 1


def test_state_is_one_set_of_files_per_table(spark, tmp_path):
    lake = ingest.Lake(spark, str(tmp_path))
    rows = [("t", f"2026-08-{d:02d}", d, 1, 10, "h") for d in range(1, 29)]
    schema = "table_name string, dt string, rows bigint, files bigint, bytes bigint, content_hash string"
    lake.save_manifest(spark.createDataFrame(rows, schema))
    lake.save_manifest(spark.createDataFrame([("t", "2026-08-03", 77, 1, 10, "h"), ("u", "2026-08-03", 1, 1, 1, "h")], schema))
    assert {r["dt"]: r["rows"] for r in lake.manifest("t").collect()} == {r[1]: r[2] for r in rows} | {"2026-08-03": 77}
    assert lake.manifest("u").count() == 1
    files = [f for _, _, names in os.walk(lake.manifest_path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 4


def test_rows_that_fail_the_gate_never_reach_readers(spark, tmp_path):
    lake_ = ingest.Lake(spark, str(tmp_path))
    tx = transactions(spark)
    ingest.incremental_extract(tx, "transactions", lake_, ingest.EPOCH, datetime(2030, 1, 1))
    before = bag(lake_.raw("transactions"))
    broken = tx.withColumn("merchant_id", F.when(F.col("txn_id") == 7, None).otherwise(F.col("merchant_id")))
    with pytest.raises(DataQualityError):
        ingest.incremental_extract(broken, "transactions", lake_, ingest.EPOCH, datetime(2030, 1, 1))
    assert bag(lake_.raw("transactions")) == before


def test_what_is_gated_is_what_is_written(spark, tmp_path):
    """A source that answers every scan of its rows differently: the lake holds one answer, and it has passed the gate."""
    lake_ = ingest.Lake(spark, str(tmp_path))
    tx = transactions(spark).withColumn("amount_paise", (F.rand() * 1e12).cast("bigint"))
    ingest.incremental_extract(tx, "transactions", lake_, ingest.EPOCH, datetime(2030, 1, 1))
    assert bag(lake_.raw("transactions").select("amount_paise")) == bag(lake_.raw("transactions").select("amount_paise"))
    manifest = lake_.manifest("transactions")
    assert manifest.agg(F.sum("rows")).first()[0] == lake_.raw("transactions").count()
