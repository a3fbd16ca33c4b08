"""Incremental, idempotent ingest: window -> changed dates -> rebuild -> overwrite -> manifest -> watermark."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expr import day, row_hash
from tidemark.operators.quality import DataQualityError, gate, partition_gate, schema_gate
from tidemark.session import checkpointed, scratch_path, small_frame
from tidemark.sources import catalog
from tidemark.sources.lake import read_partitioned, write_partition_overwrite
from tidemark.sources.oltp import in_range, in_window

EPOCH = datetime(1970, 1, 1)

WATERMARK_SCHEMA = "table_name string, high_watermark timestamp_ntz, last_run_id string"
MANIFEST_SCHEMA = "dt string, rows bigint, files bigint, bytes bigint, content_hash string, table_name string"
MANIFEST_COLUMNS = ["table_name", "dt", "rows", "files", "bytes", "content_hash"]


def resolve_window(
    interval_start: datetime | None,
    interval_end: datetime | None,
    run_after: datetime,
    first_interval: datetime,
    override_start: datetime | None = None,
    override_end: datetime | None = None,
) -> tuple[datetime, datetime]:
    """Half-open window on ``updated_at`` in naive UTC.

    A run without an interval covers the day before ``run_after``. The first interval starts at the
    epoch. Explicit bounds win over both.
    """

    def naive(ts: datetime) -> datetime:
        return ts.replace(tzinfo=None)

    if interval_start is None or interval_end is None:
        interval_end = run_after
        interval_start = run_after - timedelta(days=1)
    lo, hi = naive(interval_start), naive(interval_end)
    if lo <= naive(first_interval):
        lo = EPOCH
    return override_start or lo, override_end or hi


def changed_partitions(source: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """Creation dates of the rows changed in ``[lo, hi)``: a late update surfaces an old date.

    The window is pushed into the scan; the distinct combines on the map side, so what is shuffled is
    at most one row per day and task.
    """
    return in_window(source, lo, hi).select(day("created_at").alias("dt")).distinct()


def rebuild_partitions(source: DataFrame, changed: DataFrame, table: str) -> DataFrame:
    """Every source row, changed or not, of each changed date, in catalog column order.

    ``changed`` is reduced to distinct dates before it is broadcast. That bounds it whatever the size of
    the source: there are fewer than 3.7 million dates between the years 1 and 9999, in practice a few
    thousand. The source is neither shuffled nor skewed by a hot date.
    """
    dates = changed.select("dt").filter(F.col("dt").isNotNull()).distinct()
    rows = source.withColumn("dt", day("created_at"))
    return catalog.conform(rows.join(F.broadcast(dates), "dt", "left_semi"), table)


def partition_manifest(
    lake: DataFrame, table: str, hash_columns: list[str] | None = None, partition: str = "dt"
) -> DataFrame:
    """Rows, files, bytes and content hash per partition of a file-based frame.

    The hash does not depend on row order or file boundaries: an xor of row hashes, which cancels pairs,
    next to a sum, which does not.
    """
    columns = hash_columns or [c for c in lake.columns if c != partition]
    hashed = lake.select(
        F.col(partition).alias("dt"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        row_hash(columns).alias("h"),
    )
    low_bits = F.col("h").bitwiseAND(F.lit(0x7FFFFFFF))
    per_file = hashed.groupBy("dt", "file_path", "file_size").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor("h").alias("x"),
        F.sum(low_bits).alias("s"),
    )
    return (
        per_file.groupBy("dt")
        .agg(
            F.sum("rows").alias("rows"),
            F.count(F.lit(1)).alias("files"),
            F.sum("file_size").alias("bytes"),
            F.concat_ws("-", F.hex(F.bit_xor("x")), F.hex(F.sum("s"))).alias("content_hash"),
        )
        .select(F.lit(table).alias("table_name"), *MANIFEST_COLUMNS[1:])
    )


def content_manifest(frame: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """Rows and content hash per ``dt`` of any frame, file-based or not."""
    h = row_hash(columns or [c for c in frame.columns if c != "dt"])
    return (
        frame.select("dt", h.alias("h"))
        .groupBy("dt")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.concat_ws(
                "-", F.hex(F.bit_xor("h")), F.hex(F.sum(F.col("h").bitwiseAND(F.lit(0x7FFFFFFF))))
            ).alias("content_hash"),
        )
        .select(F.lit(table).alias("table_name"), "dt", "rows", "content_hash")
    )


def manifest_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Partitions that differ between two manifests: ``added``, ``removed`` or ``changed``.

    An empty result proves that a re-run changed nothing. File names and counts do not take part.
    """
    b, a = before.alias("b"), after.alias("a")
    joined = b.join(
        a,
        (F.col("b.table_name") == F.col("a.table_name")) & (F.col("b.dt") == F.col("a.dt")),
        "full_outer",
    )
    same = F.col("b.rows").eqNullSafe(F.col("a.rows")) & F.col("b.content_hash").eqNullSafe(
        F.col("a.content_hash")
    )
    change = (
        F.when(F.col("b.dt").isNull(), "added").when(F.col("a.dt").isNull(), "removed").when(~same, "changed")
    )
    return joined.select(
        F.coalesce("b.table_name", "a.table_name").alias("table_name"),
        F.coalesce("b.dt", "a.dt").alias("dt"),
        change.alias("change"),
        F.col("b.rows").alias("rows_before"),
        F.col("a.rows").alias("rows_after"),
    ).filter(F.col("change").isNotNull())


def advance_watermark(current: DataFrame, reached: DataFrame) -> DataFrame:
    """One row per table with the larger of both watermarks: a re-run of an old window moves nothing back.

    The run id belongs to the newest run recorded, which is the one in ``reached``.
    """
    merged = current.withColumn("_new", F.lit(0)).unionByName(reached.withColumn("_new", F.lit(1)))
    return merged.groupBy("table_name").agg(
        F.max("high_watermark").alias("high_watermark"),
        F.max_by("last_run_id", "_new").alias("last_run_id"),
    )


def late_updates(source: DataFrame) -> DataFrame:
    """Rows per creation date that were last changed on a later day."""
    late = day("updated_at") > day("created_at")
    return (
        source.filter(late)
        .groupBy(day("created_at").alias("dt"))
        .agg(F.count(F.lit(1)).alias("late_rows"))
    )


def updates_in_window(source: DataFrame, lo: datetime, hi: datetime) -> DataFrame:
    """Rows per creation date changed inside the window: which partitions a run will touch and why."""
    return (
        in_window(source, lo, hi)
        .groupBy(day("created_at").alias("dt"))
        .agg(F.count(F.lit(1)).alias("updated_rows"))
    )


MAX_INTERVALS = 64  # ranges in one pushed filter; the narrowest gaps between more are read along


def intervals(dates: list[str]) -> list[tuple[datetime, datetime]]:
    """Sorted dates as (first, last) of their runs of days, so that days between late ones are not read."""
    out: list[list[datetime]] = []
    for day_ in map(datetime.fromisoformat, dates):
        if out and day_ - out[-1][1] <= timedelta(days=1):
            out[-1][1] = day_
        else:
            out.append([day_, day_])
    while len(out) > MAX_INTERVALS:
        gaps = [b[0] - a[1] for a, b in zip(out, out[1:])]
        k = gaps.index(min(gaps))
        out[k : k + 2] = [[out[k][0], out[k + 1][1]]]
    return [(a, b) for a, b in out]


@dataclass(frozen=True)
class Lake:
    """Paths of one lake: raw tables, their manifests and their watermarks."""

    spark: SparkSession
    root: str

    def raw_path(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    def curated_path(self, table: str) -> str:
        return f"{self.root}/curated/{table}"

    def curated(self, table: str) -> DataFrame:
        return read_partitioned(self.spark, self.curated_path(table), catalog.struct_type(table))

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/_state/manifest"

    @property
    def watermark_path(self) -> str:
        return f"{self.root}/_state/watermark"

    def raw(self, table: str) -> DataFrame:
        return read_partitioned(self.spark, self.raw_path(table), catalog.struct_type(table))

    def _state(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("basePath", path).parquet(path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return small_frame(self.spark, [], schema)

    def manifest(self, table: str) -> DataFrame:
        rows = self._state(self.manifest_path, MANIFEST_SCHEMA)
        return rows.filter(F.col("table_name") == table).select(*MANIFEST_COLUMNS)

    def watermarks(self) -> DataFrame:
        schema = "high_watermark timestamp_ntz, last_run_id string, table_name string"
        return self._state(self.watermark_path, schema).select("table_name", "high_watermark", "last_run_id")

    def save_manifest(self, manifest: DataFrame) -> None:
        """Put the rows in place of those of the same table and ``dt``; one set of files per table."""
        new = manifest.select(*MANIFEST_COLUMNS)
        tables = [r["table_name"] for r in new.select("table_name").distinct().collect()]
        old = self._state(self.manifest_path, MANIFEST_SCHEMA).filter(F.col("table_name").isin(tables))
        kept = old.join(new.select("table_name", "dt"), ["table_name", "dt"], "left_anti").select(*MANIFEST_COLUMNS)
        # Checkpointed, since what is read is what will be overwritten.
        _replace_partitions(checkpointed(kept.unionByName(new)), self.manifest_path, ["table_name"])

    def save_watermark(self, table: str, hi: datetime, run_id: str | None) -> None:
        # One row per table: small enough to pass through the driver, which also breaks the
        # read-from-what-is-overwritten cycle.
        reached = small_frame(self.spark, [(table, hi, run_id)], WATERMARK_SCHEMA)
        current = self.watermarks().filter(F.col("table_name") == table)
        merged = [tuple(r) for r in advance_watermark(current, reached).collect()]
        _replace_partitions(small_frame(self.spark, merged, WATERMARK_SCHEMA), self.watermark_path, ["table_name"])


def snapshot(df: DataFrame, name: str) -> DataFrame:
    """The rows as they are now, as Parquet in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _replace_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def incremental_extract(
    source: DataFrame,
    table: str,
    lake: Lake,
    lo: datetime,
    hi: datetime,
    run_id: str | None = None,
    only_partitions: list[str] | None = None,
    check: bool = True,
) -> DataFrame:
    """Bring the lake up to date for ``[lo, hi)`` and return the manifest rows of the touched partitions.

    A source whose schema has drifted from the catalog, or that has changed rows without a creation time, stops the run
    before anything is written (unless ``check`` is off). The rows of the touched days are read from the source once, into
    the shared folder; readers of the lake see them after they have passed the quality gate. The watermark moves last, and
    not for a run restricted to given partitions, which says nothing about the window. Every step overwrites, so a failed
    or repeated run is repaired by running it again.
    """
    spark = lake.spark
    if check:
        drift = schema_gate(source, table)
        if drift:
            raise DataQualityError(drift)
    if only_partitions:
        dates = sorted(set(only_partitions))
    else:
        # The list of changed dates is the one thing the driver keeps: it is bounded by the calendar and
        # turns the later reads into directory-pruned scans.
        found = [r.dt for r in changed_partitions(source, lo, hi).collect()]
        dates = sorted(d for d in found if d is not None)
        if check and len(dates) < len(found):
            raise DataQualityError([("not_null", table, None, "changed rows without created_at belong to no day")])
    if dates:
        changed = small_frame(spark, [(d,) for d in dates], "dt string")
        # The intervals reach the scan (row-group or index skipping); the semi-join is exact.
        source = source.filter(
            reduce(
                lambda a, b: a | b,
                [in_range(F.col("created_at"), first, last + timedelta(days=1)) for first, last in intervals(dates)],
            )
        )
        # A source goes on changing: what is gated and what is written are the same rows, read once.
        extract = snapshot(source, f"extract-{table}")
        rebuilt = rebuild_partitions(extract, changed, table)
        if check:
            verdicts = partition_gate(extract, rebuilt, table, changed)
            gate(verdicts.filter(F.col("failed_check").isNotNull()))
        write_partition_overwrite(rebuilt, lake.raw_path(table), "dt", [catalog.table(table).pk])
        written = lake.raw(table).filter(F.col("dt").isin(dates))
        lake.save_manifest(partition_manifest(written, table))
    if not only_partitions:
        lake.save_watermark(table, hi, run_id)
    return lake.manifest(table).filter(F.col("dt").isin(dates))

