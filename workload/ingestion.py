"""Sources, sinks and incremental ingest over the event transactions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import ingest
from tidemark.session import scratch_path
from tidemark.sources import catalog, lake
from workload.fixtures import event_lake, event_transactions, on_events, payments

LO, HI = datetime(2024, 1, 20), datetime(2024, 1, 22)
FIRST_HI, SECOND_HI = datetime(2024, 1, 10), datetime(2024, 1, 12)
REWRITTEN_FROM = "2024-01-20"
SMALL_FILES = 8
TX = catalog.struct_type("transactions")
TX_COLUMNS = ", ".join(catalog.table("transactions").column_names)


def schema_from_catalog(spark, sf_dir):
    """Declared columns next to the values found when the tables are read with the declared schema."""
    f = payments(spark, sf_dir)
    out = None
    for name, df in (("users", f.users), ("transactions", event_lake(spark, sf_dir)[1]), ("refunds", f.refunds)):
        fields = {x.name: x for x in catalog.struct_type(name).fields}
        counts = df.agg(*[F.count(c).alias(c) for c in fields]).unpivot([], list(fields), "column_name", "non_null")
        declared = F.create_map(*[F.lit(x) for c in fields.values() for x in (c.name, c.dataType.simpleString())])
        tagged = [c.name for c in fields.values() if c.metadata["pii"]]
        part = counts.select(
            F.lit(name).alias("table_name"),
            "column_name",
            F.element_at(declared, F.col("column_name")).alias("data_type"),
            F.col("column_name").isin(tagged).alias("pii") if tagged else F.lit(False).alias("pii"),
            "non_null",
        )
        out = part if out is None else out.unionByName(part)
    return out


def write_partition_overwrite(spark, sf_dir):
    """Write everything, rewrite the later dates with doubled amounts, repeat that, and read back."""
    tx = event_transactions(spark, sf_dir)
    path = scratch_path(spark, "overwrite")
    lake.write_partition_overwrite(tx, path, "dt", ["txn_id"])
    later = tx.filter(F.col("dt") >= REWRITTEN_FROM).withColumn("amount_paise", F.col("amount_paise") * 2)
    for _ in range(2):
        lake.write_partition_overwrite(later, path, "dt", ["txn_id"])
    return lake.read_partitioned(spark, path, TX).select("txn_id", "amount_paise", "dt")


def partition_manifest(spark, sf_dir):
    _, tx = event_lake(spark, sf_dir)
    return ingest.partition_manifest(tx, "transactions").select(
        "table_name",
        "dt",
        "rows",
        "files",
        (F.col("bytes") > 0).alias("has_bytes"),
        (F.length("content_hash") > 0).alias("has_hash"),
    )


def manifest_diff(spark, sf_dir):
    """Against a copy that lacks a day, has a new one, lost rows of one and has altered amounts in another."""
    tx = event_transactions(spark, sf_dir)
    dt = F.col("dt")
    changed = (
        tx.filter(~((dt == "2024-01-05") | ((dt == "2024-01-10") & (F.col("txn_id") % 13 == 0))))
        .withColumn("amount_paise", F.col("amount_paise") + F.when(dt == "2024-01-12", 1).otherwise(0))
        .withColumn("dt", F.when(dt == "2024-01-15", "2024-02-15").otherwise(dt))
    )
    before = ingest.content_manifest(tx, "transactions")
    return ingest.manifest_diff(before, ingest.content_manifest(changed, "transactions"))


def advance_watermark(spark, sf_dir):
    """One watermark per payment status; a run that reached ``LO`` must not move a later one back."""
    tx = event_transactions(spark, sf_dir)
    current = tx.groupBy(F.col("status").alias("table_name")).agg(
        F.max(F.when(F.col("status") != "FAILED", F.col("updated_at")).otherwise(F.lit(FIRST_HI).cast("timestamp_ntz")))
        .alias("high_watermark")
    )
    reached = current.select(
        "table_name",
        F.lit(LO).cast("timestamp_ntz").alias("high_watermark"),
        F.lit("run-2").alias("last_run_id"),
    )
    return ingest.advance_watermark(current.withColumn("last_run_id", F.lit("run-1")), reached)


def late_updates(spark, sf_dir):
    tx = event_transactions(spark, sf_dir)
    zero = F.lit(0).cast("bigint")
    late, recent = ingest.late_updates(tx), ingest.updates_in_window(tx, LO, HI)
    return late.join(recent, "dt", "full_outer").select(
        "dt",
        F.coalesce("late_rows", zero).alias("late_rows"),
        F.coalesce("updated_rows", zero).alias("updated_rows"),
    )


def incremental_extract(spark, sf_dir):
    """Initial load, next window, and the initial window again; then what the lake and its state say."""
    tx = event_transactions(spark, sf_dir)
    target = ingest.Lake(spark, scratch_path(spark, "lake"))
    runs = ((ingest.EPOCH, FIRST_HI), (FIRST_HI, SECOND_HI), (ingest.EPOCH, FIRST_HI))
    for i, (lo, hi) in enumerate(runs):
        ingest.incremental_extract(tx, "transactions", target, lo, hi, run_id=f"run-{i}")
    rows = target.raw("transactions").groupBy("dt").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount_paise").alias("paise")
    )
    recorded = target.manifest("transactions").select("dt", F.col("rows").alias("manifest_rows"))
    mark = target.watermarks().filter(F.col("table_name") == "transactions").select("high_watermark").first()[0]
    return rows.join(recorded, "dt", "full_outer").withColumn(
        "high_watermark", F.lit(mark).cast("timestamp_ntz")
    )


def compact_partitions(spark, sf_dir):
    """Files per day before and after compaction of a copy cut into small files."""
    tx = event_transactions(spark, sf_dir)
    small, compacted = scratch_path(spark, "small-files"), scratch_path(spark, "compacted")
    lake.split_partitions(tx, small, SMALL_FILES, F.pmod("txn_id", F.lit(SMALL_FILES)))
    after = lake.file_stats(lake.compact_partitions(spark, small, compacted, TX))
    before = lake.file_stats(lake.read_partitioned(spark, small, TX))
    return before.select("dt", F.col("files").alias("files_before")).join(
        after.select("dt", F.col("files").alias("files_after"), "rows"), "dt", "full_outer"
    )


def register_external_table(spark, sf_dir):
    path, _ = event_lake(spark, sf_dir)
    name = "transactions_" + path.rsplit("-", 1)[-1][:12]
    partitions = lake.register_external_table(spark, name, path, TX)
    return spark.table(name).agg(
        F.lit(partitions).cast("bigint").alias("partitions"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("amount_paise").alias("paise"),
    )


def compact_clustered(spark, sf_dir):
    """Small files rewritten along a curve through creation time and merchant: the rows of each day and merchant."""
    path, _ = event_lake(spark, sf_dir)
    out = lake.compact_clustered(spark, path, scratch_path(spark, "clustered"), TX, ["created_at", "merchant_id"])
    return out.groupBy("dt", "merchant_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount_paise").alias("paise"))


QUERIES = {
    "schema_from_catalog": schema_from_catalog,
    "read_partitioned": lambda spark, sf_dir: event_lake(spark, sf_dir)[1].select(
        "txn_id", "status", "amount_paise", "created_at", "dt"
    ),
    "changed_partitions": lambda spark, sf_dir: ingest.changed_partitions(event_transactions(spark, sf_dir), LO, HI),
    "rebuild_partitions": lambda spark, sf_dir: ingest.rebuild_partitions(
        event_transactions(spark, sf_dir),
        ingest.changed_partitions(event_transactions(spark, sf_dir), LO, HI),
        "transactions",
    ),
    "write_partition_overwrite": write_partition_overwrite,
    "partition_manifest": partition_manifest,
    "manifest_diff": manifest_diff,
    "advance_watermark": advance_watermark,
    "late_updates": late_updates,
    "incremental_extract": incremental_extract,
    "compact_partitions": compact_partitions,
    "register_external_table": register_external_table,
    "compact_clustered": compact_clustered,
}

_WINDOW = "updated_at >= TIMESTAMP '2024-01-20 00:00:00' AND updated_at < TIMESTAMP '2024-01-22 00:00:00'"
_DAY = "CAST(CAST(created_at AS DATE) AS VARCHAR)"


def _schema_sql(table: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{x.name}' AS column_name, '{x.dataType.simpleString()}' AS data_type, "
        f"{str(x.metadata['pii']).lower()} AS pii, count({x.name}) AS non_null FROM {table}"
        for x in catalog.struct_type(table).fields
    )


ORACLES = {
    "schema_from_catalog": on_events(
        "\nUNION ALL\n".join(_schema_sql(t) for t in ("users", "transactions", "refunds"))
    ),
    "read_partitioned": on_events("SELECT txn_id, status, amount_paise, created_at, dt FROM transactions"),
    "changed_partitions": on_events(f"SELECT DISTINCT {_DAY} AS dt FROM transactions WHERE {_WINDOW}"),
    "rebuild_partitions": on_events(
        f"""SELECT {TX_COLUMNS} FROM transactions
            WHERE {_DAY} IN (SELECT {_DAY} FROM transactions WHERE {_WINDOW})"""
    ),
    "write_partition_overwrite": on_events(
        f"""SELECT txn_id, CASE WHEN dt >= '{REWRITTEN_FROM}' THEN 2 ELSE 1 END * amount_paise AS amount_paise, dt
            FROM transactions"""
    ),
    "partition_manifest": on_events(
        """SELECT 'transactions' AS table_name, dt, count(*) AS rows, CAST(1 AS BIGINT) AS files, true AS has_bytes,
                  true AS has_hash FROM transactions GROUP BY dt"""
    ),
    "manifest_diff": on_events(
        """SELECT 'transactions' AS table_name, dt,
                  CASE WHEN b IS NULL THEN 'added' WHEN a IS NULL THEN 'removed' ELSE 'changed' END AS change,
                  b AS rows_before, a AS rows_after
           FROM (SELECT dt, count(*) AS b FROM transactions GROUP BY dt)
           FULL JOIN (SELECT CASE WHEN dt = '2024-01-15' THEN '2024-02-15' ELSE dt END AS dt, count(*) AS a
                      FROM transactions WHERE dt <> '2024-01-05' AND NOT (dt = '2024-01-10' AND txn_id % 13 = 0)
                      GROUP BY 1) USING (dt)
           WHERE b IS DISTINCT FROM a OR dt = '2024-01-12'"""
    ),
    "advance_watermark": on_events(
        """SELECT status AS table_name,
                  greatest(CASE WHEN status = 'FAILED' THEN TIMESTAMP '2024-01-10 00:00:00' ELSE max(updated_at) END,
                           TIMESTAMP '2024-01-20 00:00:00') AS high_watermark, 'run-2' AS last_run_id
           FROM transactions GROUP BY status"""
    ),
    "late_updates": on_events(
        f"""SELECT {_DAY} AS dt, count(*) FILTER (WHERE CAST(updated_at AS DATE) > CAST(created_at AS DATE)) AS late_rows,
                   count(*) FILTER (WHERE {_WINDOW}) AS updated_rows
            FROM transactions GROUP BY 1 HAVING late_rows > 0 OR updated_rows > 0"""
    ),
    "incremental_extract": on_events(
        """SELECT dt, count(*) AS rows, CAST(sum(amount_paise) AS BIGINT) AS paise, count(*) AS manifest_rows,
                  TIMESTAMP '2024-01-12 00:00:00' AS high_watermark
           FROM transactions
           WHERE dt IN (SELECT dt FROM transactions WHERE updated_at < TIMESTAMP '2024-01-12 00:00:00') GROUP BY dt"""
    ),
    "compact_partitions": on_events(
        f"""SELECT dt, count(DISTINCT txn_id % {SMALL_FILES}) AS files_before, CAST(1 AS BIGINT) AS files_after,
                   count(*) AS rows FROM transactions GROUP BY dt"""
    ),
    "compact_clustered": on_events(
        """SELECT dt, merchant_id, count(*) AS rows, CAST(sum(amount_paise) AS BIGINT) AS paise FROM transactions
           GROUP BY dt, merchant_id"""
    ),
    "register_external_table": on_events(
        """SELECT count(DISTINCT dt) AS partitions, count(*) AS rows, CAST(sum(amount_paise) AS BIGINT) AS paise
           FROM transactions"""
    ),
}
