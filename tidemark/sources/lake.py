"""Day-partitioned Parquet tables: read, overwrite whole partitions, compact, register, measure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType | None = None, partition: str = "dt"
) -> DataFrame:
    """Read a Hive-layout table with its partition column as text.

    With a declared schema nothing is inferred and no file footer is opened for it, and the partition
    column keeps the declared string type, so a literal filter on it prunes directories. Without one the schema is
    inferred first and its partition column then declared as text; no session setting is touched.
    """
    reader = spark.read.option("basePath", path)
    if schema is None:
        fields = reader.parquet(path).schema.fields
        schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == partition else f for f in fields])
    return reader.schema(schema).parquet(path)


def by_partition(df: DataFrame, partition: str, sort_by: list[str] | None = None) -> DataFrame:
    """Lay rows out so that each partition value is written by one task, unless it is too big for one.

    REBALANCE hashes on the partition column and lets AQE split a partition value that exceeds the
    advisory size and merge small ones. A normal day becomes one file; a day that holds a third of the
    table becomes as many files as its size asks for, and no task carries it alone.
    """
    out = df.hint("rebalance", F.col(partition))
    return out.sortWithinPartitions(partition, *(sort_by or []))


def write_partition_overwrite(
    df: DataFrame, path: str, partition: str = "dt", sort_by: list[str] | None = None
) -> None:
    """Replace exactly the partitions that occur in ``df``; never append, so a re-run changes nothing."""
    (
        by_partition(df, partition, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(partition)
        .parquet(path)
    )


def compact_partitions(
    spark: SparkSession, source: str, target: str, schema: T.StructType, partition: str = "dt"
) -> DataFrame:
    """Rewrite a table of many small files into ``target`` and return the table read from there."""
    write_partition_overwrite(read_partitioned(spark, source, schema), target, partition)
    return read_partitioned(spark, target, schema)


RANK_BITS = 6


def curve_position(df: DataFrame, by: list[str], bits: int = RANK_BITS) -> Column:
    """Place of a row on a curve through the space of the columns: their ranks, bit by bit in turn (Z-order).

    A rank says between which of the column's quantiles a value lies, so every column counts alike, whatever its values
    and however they are spread. The quantiles, 2**bits - 1 per column, are fetched in one pass; they decide where a row is
    stored, never whether. Nulls come first. Columns are numbers, dates or times.
    """
    n = 1 << bits
    shares = [i / n for i in range(1, n)]
    found = df.agg(*[F.percentile_approx(c, shares, 100 * n).alias(f"q{i}") for i, c in enumerate(by)]).first()

    def rank(column: str, bounds: list, low: int = 0) -> Column:
        """Number of bounds below the value, by halves."""
        if not bounds:
            return F.lit(low)
        middle = len(bounds) // 2
        left, right = rank(column, bounds[:middle], low), rank(column, bounds[middle + 1 :], low + middle + 1)
        return F.when(F.col(column) > F.lit(bounds[middle]), right).otherwise(left)

    place = F.lit(0)
    for i, column in enumerate(by):
        own = rank(column, list(found[f"q{i}"] or []))
        for b in range(bits):
            bit = F.shiftright(own, b).bitwiseAND(F.lit(1))
            place = place.bitwiseOR(F.shiftleft(bit, b * len(by) + len(by) - 1 - i))
    return place


def compact_clustered(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    by: list[str],
    partition: str = "dt",
    files: int | None = None,
    row_group_bytes: int | None = None,
) -> DataFrame:
    """Rewrite a table so that, within a partition, rows near each other in all of ``by`` share row groups.

    A filter on any of the columns then skips most row groups by their statistics. Partitions and curve are split by range
    over ``files`` tasks, so a partition of any size is spread out. Returns the table read from ``target``.
    """
    df = read_partitioned(spark, source, schema)
    placed = df.withColumn("_place", curve_position(df, by))
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = placed.repartitionByRange(n, partition, "_place", *by).sortWithinPartitions(partition, "_place", *by)
    writer = laid.drop("_place").write.mode("overwrite").option("compression", "snappy")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(target)
    return read_partitioned(spark, target, schema)


def split_partitions(df: DataFrame, path: str, files: int, slot: Column, partition: str = "dt") -> None:
    """The reverse of compaction: up to ``files`` files per partition, the layout that compaction repairs.

    ``slot`` is an integer expression from 0 to ``files - 1``: the file of a row within its partition.
    """
    (
        df.repartitionById(files, slot.cast("int"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(partition)
        .parquet(path)
    )


def file_stats(df: DataFrame, partition: str = "dt", where: Column | None = None) -> DataFrame:
    """Files, bytes and rows per partition of a file-based frame, from the hidden file metadata.

    ``where`` limits which rows are counted, not which files: those are all files the frame opens. The
    first aggregate has one row per file, the second one per partition; both combine on the map side, so
    a partition of any size only sends its file names.
    """
    counted = F.count(F.lit(1)) if where is None else F.count_if(where)
    per_file = df.groupBy(
        partition,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
    ).agg(counted.alias("rows"))
    return per_file.groupBy(partition).agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
    )


def scan_profile(
    variants: dict[str, DataFrame], where: dict[str, Column] | None = None, partition: str = "dt"
) -> DataFrame:
    """What each query variant reads: partitions, files, whole-file bytes, and rows that qualify.

    A variant is a frame with its filters on the partition column, which decide the files that are
    opened; ``where`` holds its other filters, which only decide the rows that qualify.
    """
    frames = [
        file_stats(df, partition, (where or {}).get(label))
        .agg(
            F.count(F.lit(1)).alias("partitions"),
            F.coalesce(F.sum("files"), F.lit(0)).cast("bigint").alias("files"),
            F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
            F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        )
        .select(F.lit(label).alias("variant"), "partitions", "files", "rows", "bytes")
        for label, df in variants.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, partition: str) -> None:
    """Put ``df`` in place of its partitions of a catalog table that is bucketed and sorted by ``key``.

    Two such tables with one number of buckets join on the key without moving a row. Each bucket is written by one task,
    one file per partition; the key should be (nearly) unique. The table is created at ``path`` if it is missing.
    """
    spark = df.sparkSession
    laid = df.repartition(buckets, key)
    if not spark.catalog.tableExists(name):
        writer = laid.write.format("parquet").option("path", path).option("compression", "snappy")
        writer.partitionBy(partition).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        laid.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def register_external_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    partition: str = "dt",
    analyze: bool = True,
    touched: list[str] | None = None,
) -> int:
    """Create the external table if it is missing, bring its partitions up to date, count them.

    A table of that name with another path or other columns is an error. ``touched`` names the partitions a run wrote: only
    they are added and analysed. Without it all partitions are synchronised with the folders. Statistics are row
    counts from the file footers.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if spark.catalog.tableExists(name):
        known = spark.table(name).schema
        place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
        plain = lambda p: p.removeprefix("file:").rstrip("/")
        if plain(place) != plain(path):
            raise ValueError(f"{name} is registered at {place}, not at {path}")
        if {(f.name, f.dataType) for f in known} != {(f.name, f.dataType) for f in schema}:
            raise ValueError(f"{name} is registered with other columns: {known.simpleString()}")
    else:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}'")
        touched = None
    if touched is None:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        if analyze:
            spark.sql(f"ANALYZE TABLE {name} PARTITION (`{partition}`) COMPUTE STATISTICS")
    elif touched:
        parts = [f"PARTITION (`{partition}` = '{value}')" for value in sorted(set(touched))]
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
        for part in parts if analyze else []:
            spark.sql(f"ANALYZE TABLE {name} {part} COMPUTE STATISTICS")
    return spark.sql(f"SHOW PARTITIONS {name}").count()
