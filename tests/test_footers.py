"""Bytes of scans, next to footers read by hand and to what Spark says it has read."""

import datetime
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.sources.footers import Scan, column_chunks, executed_bytes, read_files, scan_bytes, within_ranges

DAY = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Three days; within each the rows are sorted by k over several row groups."""
    path = str(tmp_path_factory.mktemp("footers") / "t")
    df = spark.range(60_000).select(
        F.col("id").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("wide"),
        (F.col("id") % 5).cast("int").alias("few"),
        F.array(F.col("id"), F.col("id") * 7).alias("items"),
        F.expr(f"TIMESTAMP_NTZ '{DAY}' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("at"),
        F.concat(F.lit("2024-01-0"), 1 + F.col("id") % 3).alias("dt"),
    )
    out = df.repartition("dt").sortWithinPartitions("dt", "k")
    out.write.option("parquet.block.size", 200_000).partitionBy("dt").parquet(path)
    return spark.read.parquet(path), path


def by_hand(path, days, columns=None, keep=lambda group: True):
    groups = read = size = 0
    for day in days:
        for f in glob.glob(f"{path}/dt={day}/*.parquet"):
            footer = pq.read_metadata(f)
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                chunks = [group.column(c) for c in range(group.num_columns)]
                groups += 1
                if keep({c.path_in_schema: c.statistics for c in chunks}):
                    read += 1
                    own = [c for c in chunks if columns is None or c.path_in_schema.split(".")[0] in columns]
                    size += sum(c.total_compressed_size for c in own)
    return groups, read, size


def test_columns_partitions_and_ranges(stored):
    df, path = stored
    df = df.withColumn("dt", F.col("dt").cast("string"))
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    late = DAY + datetime.timedelta(seconds=50_000)
    out = {
        r["variant"]: r
        for r in scan_bytes(
            {
                "all": Scan(df),
                "two": Scan(df, ("k", "few")),
                "nested": Scan(df, ("items",)),
                "day": Scan(df.filter("dt = '2024-01-02'"), ("k", "few")),
                "range": Scan(df, ("few",), {"k": (1000, 2000)}),
                "late": Scan(df, None, {"at": (late, None)}),
                "never": Scan(df, ("few",), {"k": (10**9, None)}),
            }
        ).collect()
    }

    def figures(label):
        return tuple(out[label][c] for c in ("row_groups", "row_groups_read", "bytes_read"))

    assert figures("all") == by_hand(path, days)
    assert figures("two") == by_hand(path, days, {"k", "few"})
    assert figures("nested") == by_hand(path, days, {"items"})
    assert figures("day") == by_hand(path, days[1:2], {"k", "few"})
    assert figures("range") == by_hand(path, days, {"k", "few"}, lambda s: s["k"].max >= 1000 and s["k"].min <= 2000)
    assert figures("late") == by_hand(path, days, None, lambda s: s["at"].max >= late)
    assert out["never"]["bytes_read"] == 0 and out["never"]["row_groups_read"] == 0
    assert out["two"]["bytes_read"] < out["all"]["bytes_read"] / 3
    assert out["two"]["bytes"] == out["all"]["bytes"]
    assert out["two"]["chunk_bytes"] == out["all"]["chunk_bytes"] == out["all"]["bytes_read"]
    assert out["day"]["partitions"] == 1 and out["all"]["partitions"] == 3
    assert 0 < out["range"]["row_groups_read"] < out["range"]["row_groups"]


def test_no_files(stored):
    df, _ = stored
    row = scan_bytes({"none": Scan(df.filter("dt = '1999-01-01'"))}).first()
    assert [row[c] for c in ("partitions", "files", "bytes", "row_groups", "row_groups_read", "chunk_bytes", "bytes_read")] == [0] * 7


def test_columns_without_statistics_are_never_outside(stored):
    df, _ = stored
    chunks = column_chunks(read_files(df, "dt"), {"items": (5, 6)})
    assert chunks.filter("column = 'items' AND outside").count() == 0


def test_spark_reads_what_the_footers_say(stored):
    df, _ = stored
    variants = {
        "all": Scan(df),
        "two": Scan(df, ("k", "few")),
        "range": Scan(df, ("few",), {"k": (1000, 2000)}),
    }
    profile = scan_bytes(variants).collect()
    said = {r["variant"]: r["bytes_read"] for r in profile}
    pieces = {r["variant"]: r["row_groups_read"] * 7 + r["files"] * 4 for r in profile}
    ran = {r["variant"]: r for r in executed_bytes({k: s.rows() for k, s in variants.items()}).collect()}
    assert ran["all"]["rows_read"] == 60_000
    for k in variants:
        # Footers come on top, and up to a buffer for each seek.
        assert said[k] <= ran[k]["bytes_read"] <= said[k] + pieces[k] * 65536, k
    assert ran["range"]["bytes_read"] < ran["two"]["bytes_read"] < ran["all"]["bytes_read"]


def test_files_outside_the_ranges_are_not_read(spark, tmp_path):
    """Times without a zone, which no filter of Spark's own skips by."""
    path = str(tmp_path / "t")
    df = spark.range(300_000).select(
        F.col("id").alias("k"),
        F.expr(f"TIMESTAMP_NTZ '{DAY}' + make_interval(0, 0, 0, id div 100000, 0, 0, id % 100000 / 2)").alias("at"),
        F.concat(F.lit("2024-01-0"), 1 + F.call_function("div", F.col("id"), F.lit(100_000))).alias("dt"),
    )
    df.repartition("dt").write.partitionBy("dt").parquet(path)
    stored = spark.read.schema("k bigint, at timestamp_ntz, dt string").parquet(path)
    day = DAY + datetime.timedelta(days=1)
    scan = Scan(stored, ("k",), {"at": (day, day + datetime.timedelta(seconds=86_399))})
    narrow = within_ranges(scan)
    assert narrow.rows().count() == scan.rows().count() == 100_000
    by_footers = scan_bytes({"day": scan}).first()["bytes_read"]
    read = {r["variant"]: r for r in executed_bytes({"all": scan.rows(), "day": narrow.rows()}).collect()}
    assert read["all"]["rows_read"] == 300_000 and read["day"]["rows_read"] == 100_000
    assert by_footers <= read["day"]["bytes_read"] < by_footers + 11 * 65536 < read["all"]["bytes_read"]
    none = Scan(stored, ("k",), {"at": (day + datetime.timedelta(days=9), None)})
    assert within_ranges(none).rows().count() == 0
