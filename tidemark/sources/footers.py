"""What a scan of Parquet files reads: column chunks by the files' footers, and bytes by the metrics of a run.

Footers are read in tasks, one file at a time, by the file systems that Arrow knows (local, HDFS, S3, GCS); of a
file of any size only its last kilobytes travel.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import small_frame


VECTORED = "parquet.hadoop.vectored.io.enabled"


@dataclass(frozen=True)
class Scan:
    """A frame with its partition filters, the columns that a query over it needs (None: all), and closed ranges of stored
    columns (None: open) that its rows must lie in.
    """

    df: DataFrame
    columns: tuple[str, ...] | None = None
    ranges: dict[str, tuple[object, object]] = field(default_factory=dict)

    def rows(self) -> DataFrame:
        """The rows and columns that the query reads, as Spark would plan it."""
        df = self.df
        for name, (low, high) in self.ranges.items():
            df = df if low is None else df.filter(F.col(name) >= F.lit(low))
            df = df if high is None else df.filter(F.col(name) <= F.lit(high))
        return df if self.columns is None else df.select(*self.columns)


def _opened(path: str):
    import pyarrow.parquet as pq
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:") :]
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as f:
        return pq.read_metadata(f)


def column_chunks(files: DataFrame, ranges: dict[str, tuple[object, object]] | None = None) -> DataFrame:
    """``file_path, row_group, rows, column, bytes, outside``: one row per column chunk of the files at ``file_path``.

    ``bytes`` are compressed. ``outside`` says that the chunk's smallest and largest value leave no value in the column's
    range; chunks without such statistics, or inside a struct, array or map, are never outside. The latter count to the
    column they are part of.
    """
    wanted = dict(ranges or {})
    kind = pa.schema(
        [("file_path", pa.string()), ("row_group", pa.int32()), ("rows", pa.int64()), ("column", pa.string()),
         ("bytes", pa.int64()), ("outside", pa.bool_())]
    )

    def outside(name: str, stats) -> bool:
        if name not in wanted or stats is None or not stats.has_min_max:
            return False
        low, high = wanted[name]
        return (low is not None and stats.max < low) or (high is not None and stats.min > high)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file_path").to_pylist():
                footer, rows = _opened(path), []
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        name, _, inner = chunk.path_in_schema.partition(".")
                        apart = not inner and outside(name, chunk.statistics)
                        rows.append((path, g, group.num_rows, name, chunk.total_compressed_size, apart))
                if rows:
                    arrays = [pa.array(v, type=f.type) for v, f in zip(zip(*rows), kind)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=kind)

    ddl = "file_path string, row_group int, rows bigint, column string, bytes bigint, outside boolean"
    return files.select("file_path").mapInArrow(run, ddl)


def read_files(df: DataFrame, partition: str) -> DataFrame:
    """``partition value, file_path, bytes`` of each file that the frame opens. Files without rows are never seen."""
    return df.groupBy(F.col(partition).alias("part"), F.col("_metadata.file_path").alias("file_path")).agg(
        F.any_value("_metadata.file_size").alias("bytes")
    )


def scan_bytes(variants: dict[str, Scan], partition: str = "dt") -> DataFrame:
    """Per variant ``partitions, files, bytes, row_groups, row_groups_read, chunk_bytes, bytes_read``.

    ``bytes`` is what the files hold, ``chunk_bytes`` all their column chunks, and ``bytes_read`` the chunks of the needed columns (with those of the ranges) in the
    row groups that no range excludes.
    """
    frames = []
    for label, scan in variants.items():
        files = read_files(scan.df, partition)
        chunks = column_chunks(files, scan.ranges)
        needed = None if scan.columns is None else {*scan.columns, *scan.ranges}
        own = F.lit(True) if needed is None else F.col("column").isin(sorted(needed))
        groups = chunks.groupBy("file_path", "row_group").agg(
            F.max("outside").alias("skipped"),
            F.sum(F.when(own, F.col("bytes")).otherwise(0)).alias("needed"),
            F.sum("bytes").alias("every"),
        )
        opened = files.agg(
            F.count_distinct("part").alias("partitions"),
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        )
        read = groups.agg(
            F.count(F.lit(1)).alias("row_groups"),
            F.count_if(~F.col("skipped")).alias("row_groups_read"),
            F.coalesce(F.sum("every"), F.lit(0)).cast("bigint").alias("chunk_bytes"),
            F.coalesce(F.sum(F.when(~F.col("skipped"), F.col("needed"))), F.lit(0)).cast("bigint").alias("bytes_read"),
        )
        both = opened.unionByName(read, allowMissingColumns=True)
        frames.append(both.withColumn("variant", F.lit(label)))
    figures = ("partitions", "files", "bytes", "row_groups", "row_groups_read", "chunk_bytes", "bytes_read")
    # Two rows for each variant, each with a part of the figures.
    return reduce(DataFrame.unionByName, frames).groupBy("variant").agg(*[F.max(c).alias(c) for c in figures])


def within_ranges(scan: Scan, partition: str = "dt") -> Scan:
    """The same scan over only those of its files that hold a row group inside the ranges, by their footers.

    Spark skips row groups by its own filters, but not by times without a zone. A filter on the path is applied when files
    are listed, so the others are never opened. The paths of the files to read pass the driver, as in any listing.
    """
    if not scan.ranges:
        return scan
    chunks = column_chunks(read_files(scan.df, partition), scan.ranges)
    groups = chunks.groupBy("file_path", "row_group").agg(F.max("outside").alias("skipped"))
    paths = [r["file_path"] for r in groups.filter(~F.col("skipped")).select("file_path").distinct().collect()]
    return Scan(scan.df.filter(F.col("_metadata.file_path").isin(paths)), scan.columns, scan.ranges)


def executed_bytes(variants: dict[str, DataFrame]) -> DataFrame:
    """Run each frame, throw its rows away, and report ``variant, tasks, rows_read, bytes_read`` of its scans.

    The figures are Spark's own input metrics, footers and page headers included, summed over the stages of the run. They
    are kept per thread, so vectored reads, which leave the task's thread, are off for these runs.
    """
    if not variants:
        raise ValueError("no variants")
    spark = next(iter(variants.values())).sparkSession
    before = spark.conf.get(VECTORED, None)
    spark.conf.set(VECTORED, "false")
    try:
        rows = [_executed(label, df) for label, df in variants.items()]
    finally:
        spark.conf.unset(VECTORED) if before is None else spark.conf.set(VECTORED, before)
    return small_frame(spark, rows, "variant string, tasks bigint, rows_read bigint, bytes_read bigint")


def _executed(label: str, df: DataFrame) -> tuple[str, int, int, int]:
    context = df.sparkSession.sparkContext
    store = context._jsc.sc().statusStore()
    group = f"scan-{uuid.uuid4().hex}"
    context.setJobGroup(group, f"scan profile of {label}")
    try:
        df.write.format("noop").mode("overwrite").save()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    context._jsc.sc().listenerBus().waitUntilEmpty()
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    tasks = rows = size = 0
    for stage in stages:
        try:
            data = store.lastStageAttempt(stage)
        except Py4JJavaError:
            continue  # skipped, because another stage had its result
        if data.inputBytes():
            tasks, rows, size = tasks + data.numTasks(), rows + data.inputRecords(), size + data.inputBytes()
    return label, tasks, rows, size
