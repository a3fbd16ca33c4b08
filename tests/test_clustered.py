"""Tables laid out along a curve: the same rows, fewer row groups for a filter on any of the columns."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import bag
from tidemark.sources import catalog, lake
from tidemark.sources.footers import Scan, scan_bytes

TX = catalog.struct_type("transactions")
DAY = datetime(2026, 8, 20)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("clustered")
    rng = random.Random(1)
    rows = []
    for i in range(40_000):
        at = DAY + timedelta(seconds=rng.randrange(2 * 86400))
        merchant = None if rng.random() < 0.01 else rng.choice([7, rng.randrange(500), rng.randrange(500)])
        rows.append((i, str(i), i % 7, merchant, rng.randrange(10**6), "SUCCESS", None, at, at, at.date().isoformat()))
    df = spark.createDataFrame(rows, TX)
    lake.write_partition_overwrite(df.repartition(6), f"{root}/raw", "dt", ["created_at"])
    small = {"row_group_bytes": 60_000, "files": 2}
    by = ["created_at", "merchant_id"]
    curve = lake.compact_clustered(spark, f"{root}/raw", f"{root}/curve", TX, by, **small)
    by_time = lake.compact_clustered(spark, f"{root}/raw", f"{root}/time", TX, by[:1], **small)
    return df, curve, by_time


def test_the_rows_stay(tables):
    df, curve, by_time = tables
    assert bag(df) == bag(curve) == bag(by_time)


def groups(df, ranges):
    row = scan_bytes({"x": Scan(df, ("amount_paise",), ranges)}).first()
    return row["row_groups_read"], row["row_groups"]


def test_a_filter_on_either_column_opens_fewer_row_groups(tables):
    _, curve, by_time = tables
    merchant = {"merchant_id": (123, 123)}
    read, every = groups(curve, merchant)
    plain, plain_every = groups(by_time, merchant)
    assert plain == plain_every and every > 20
    assert read <= 0.5 * every
    hour = {"created_at": (DAY + timedelta(hours=5), DAY + timedelta(hours=6))}
    read, every = groups(curve, hour)
    assert read <= 0.4 * every


def test_positions_follow_the_ranks(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("a"), (F.col("id") / 16).cast("int").alias("b"))
    out = df.withColumn("at", lake.curve_position(df, ["a", "b"], 4)).collect()
    for r in out:
        expected = 0
        for bit in range(4):
            expected |= (r["a"] >> bit & 1) << (2 * bit + 1) | (r["b"] >> bit & 1) << (2 * bit)
        assert r["at"] == expected


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 1.5), (None, None)], "a bigint, b double")
    assert {r["at"] for r in df.withColumn("at", lake.curve_position(df, ["a", "b"])).collect()} != {None}
    none = df.filter("false")
    assert none.withColumn("at", lake.curve_position(none, ["a", "b"])).count() == 0
