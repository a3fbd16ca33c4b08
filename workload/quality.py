"""Data-quality checks and reconciliation, each over data with injected faults."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality, reconcile
from tidemark.session import small_frame
from tidemark.sources import catalog
from workload.fixtures import event_transactions, on_events, on_payments, payments, table

NOW = datetime(2001, 8, 5, 12)
MISSING_DAY, SHORT_DAY, NULL_DAY, REPEATED_DAY, EXTRA_DAY = (
    "2024-01-05",
    "2024-01-20",
    "2024-01-22",
    "2024-01-24",
    "2024-02-10",
)
KEYS = catalog.table("transactions").not_null_columns


def faulty_lake(tx: DataFrame) -> DataFrame:
    """The transactions with a day missing, rows missing, null keys, repeated keys and a day too many."""
    dt, key = F.col("dt"), F.col("txn_id")
    kept = tx.filter(~((dt == MISSING_DAY) | ((dt == SHORT_DAY) & (key % 13 == 0))))
    extra = tx.filter(dt == "2024-01-01").withColumn("dt", F.lit(EXTRA_DAY))
    faulty = kept.withColumns(
        {
            "txn_id": F.when((dt == NULL_DAY) & (key % 97 == 0), F.lit(None))
            .when(dt == REPEATED_DAY, key - key % 2)
            .otherwise(key),
            "payer_user_id": F.when((dt == NULL_DAY) & (key % 89 == 0), F.lit(None)).otherwise(
                F.col("payer_user_id")
            ),
        }
    )
    return faulty.unionByName(extra)


# The same in SQL.
_LAKE = f"""lake AS (
  SELECT * REPLACE (
    CASE WHEN dt = '{NULL_DAY}' AND txn_id % 97 = 0 THEN NULL
         WHEN dt = '{REPEATED_DAY}' THEN txn_id - txn_id % 2 ELSE txn_id END AS txn_id,
    CASE WHEN dt = '{NULL_DAY}' AND txn_id % 89 = 0 THEN NULL ELSE payer_user_id END AS payer_user_id)
  FROM transactions WHERE NOT (dt = '{MISSING_DAY}' OR (dt = '{SHORT_DAY}' AND txn_id % 13 = 0))
  UNION ALL SELECT * REPLACE ('{EXTRA_DAY}' AS dt) FROM transactions WHERE dt = '2024-01-01')"""


def _both(fn):
    def run(spark, sf_dir):
        tx = event_transactions(spark, sf_dir)
        return fn(tx, faulty_lake(tx))

    return run


def source_maxima(spark, sf_dir) -> DataFrame:
    f = payments(spark, sf_dir)
    parts = [
        getattr(f, name).agg(F.max("updated_at").alias("source_max_updated")).select(
            F.lit(name).alias("table_name"), "source_max_updated"
        )
        for name in ("users", "merchants", "transactions", "refunds")
    ]
    return reduce(DataFrame.unionByName, parts)


def watermarks(maxima: DataFrame) -> DataFrame:
    """Transactions 30 hours behind their source, merchants never loaded, the others at their source."""
    behind = F.when(F.col("table_name") == "transactions", 30).otherwise(0)
    mark = F.col("source_max_updated") - F.make_dt_interval(hours=behind)
    return maxima.filter(F.col("table_name") != "merchants").select("table_name", mark.alias("high_watermark"))


def _fresh(check):
    def run(spark, sf_dir):
        maxima = source_maxima(spark, sf_dir)
        return check(watermarks(maxima), maxima, NOW)

    return run


def dq_schema_drift(spark, sf_dir):
    """Drift of three altered tables, with the number of values each live column holds."""
    f = payments(spark, sf_dir)
    live = {
        "users": f.users,
        "transactions": f.transactions.withColumn("device_id", F.col("upi_ref")).drop("failure_code"),
        "refunds": f.refunds.withColumn("amount_paise", F.col("amount_paise").cast("double")),
    }
    live = {name: df.drop("dt") for name, df in live.items()}
    drift = quality.schema_drift(
        quality.schema_columns(spark, {n: df.schema for n, df in live.items()}),
        quality.declared_columns(spark, list(live)),
    )
    counts = [
        df.agg(*[F.count(c).alias(c) for c in df.columns])
        .unpivot([], df.columns, "column_name", "live_values")
        .select(F.lit(n).alias("table_name"), "column_name", "live_values")
        for n, df in live.items()
    ]
    found = drift.join(reduce(DataFrame.unionByName, counts), ["table_name", "column_name"], "left")
    return found.select("table_name", "column_name", "drift", "live_values")


def dq_partition_exists(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").cast("string").alias("dt"))
    return quality.partition_exists(quality.calendar(days), days)


def dq_unique_key(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    return quality.unique_key(items, ["l_orderkey", "l_linenumber"], "l_linestatus")


def reconcile_counts(tx, lake):
    manifest = lake.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))
    return reconcile.reconcile_counts(tx, manifest)


def curated_vs_source(spark, sf_dir, cells=False):
    """Both curated tables, altered in places, against independent formulations."""
    f = payments(spark, sf_dir)
    one = F.col("merchant_id")
    metrics = (
        f.daily_merchant_metrics.filter(one != 3)
        .withColumn("txn_count", F.col("txn_count") + F.when(one == 5, 1).otherwise(0))
        .withColumn("dt", F.when((one == 7) & (F.col("dt") < "1996-01-01"), "2030-01-01").otherwise(F.col("dt")))
        .dropDuplicates(["dt", "merchant_id"])
    )
    week = F.col("weeks_since_signup")
    cohorts = f.user_cohorts.filter(week != 2).withColumn(
        "active_users", F.col("active_users") + F.when(week == 4, 1).otherwise(0)
    )
    return reconcile.curated_vs_source(f.users, f.transactions, f.transactions, f.refunds, metrics, cohorts, cells)


def dq_report(spark, sf_dir):
    """Every check on the newest day of every source table.

    The transactions carry the injected faults, the source of the merchants has a retyped and an added column, and the lake
    of the users has lost its key, so that its checks cannot run.
    """
    f = payments(spark, sf_dir)
    tx = event_transactions(spark, sf_dir)
    drifted = f.merchants.withColumns({"merchant_id": F.col("merchant_id").cast("double"), "note": F.lit("x")})
    tables = {
        "users": (f.users, f.users.drop("user_id")),
        "merchants": (drifted, f.merchants),
        "refunds": (f.refunds, f.refunds),
        "transactions": (tx, faulty_lake(tx)),
    }
    maxima = source_maxima(spark, sf_dir)
    found = quality.latest_report(tables, watermarks(maxima), maxima, NOW)
    return found.select("table_name", "check_name", "status")


QUERIES = {
    "dq_row_count": _both(quality.row_count),
    "dq_not_null": _both(lambda tx, lake: quality.not_null(lake, KEYS)),
    "dq_unique_key": dq_unique_key,
    "dq_partition_exists": dq_partition_exists,
    "dq_freshness": _fresh(quality.freshness),
    "freshness_status": _fresh(quality.freshness_status),
    "dq_schema_drift": dq_schema_drift,
    "dq_partition_gate": _both(
        lambda tx, lake: quality.partition_gate(tx, lake, "transactions").drop("detail")
    ),
    "reconcile_counts": _both(reconcile_counts),
    "reconcile_recent": _both(
        lambda tx, lake: reconcile.reconcile_recent(tx, lake, "transactions").filter(
            F.col("failed_check").isNotNull()
        )
    ),
    "curated_vs_source": curated_vs_source,
    "curated_vs_source_cells": lambda spark, sf_dir: curated_vs_source(spark, sf_dir, cells=True),
    "dq_report": dq_report,
}

_MAXIMA = """maxima AS (
  SELECT 'users' AS table_name, max(updated_at) AS source_max_updated FROM users
  UNION ALL SELECT 'merchants', max(updated_at) FROM merchants
  UNION ALL SELECT 'transactions', max(updated_at) FROM transactions
  UNION ALL SELECT 'refunds', max(updated_at) FROM refunds),
marks AS (
  SELECT *, CASE table_name WHEN 'merchants' THEN NULL WHEN 'transactions' THEN source_max_updated - INTERVAL 30 HOUR
                            ELSE source_max_updated END AS high_watermark FROM maxima)"""
_NOW = "TIMESTAMP '2001-08-05 12:00:00'"
_FRESHNESS = f"""CASE WHEN high_watermark IS NULL THEN 'never_loaded'
       WHEN {_NOW} - high_watermark > INTERVAL 26 HOUR THEN 'watermark_behind_now'
       WHEN source_max_updated - high_watermark > INTERVAL 26 HOUR THEN 'source_ahead_of_watermark'
       ELSE 'fresh' END"""
_GATE = """gated AS (
  SELECT s.dt, s.n AS source_rows, coalesce(l.n, 0) AS lake_rows,
         CASE WHEN l.n IS NULL THEN 'partition_exists' WHEN s.n <> l.n THEN 'row_count'
              WHEN l.nulls > 0 THEN 'not_null' WHEN l.n <> l.k + l.has_null THEN 'unique_key' END AS failed_check,
         l.null_txn, l.null_payer, l.k + l.has_null AS k
  FROM (SELECT dt, count(*) AS n FROM transactions GROUP BY dt) s
  LEFT JOIN (SELECT dt, count(*) AS n, count(DISTINCT txn_id) AS k, max(CAST(txn_id IS NULL AS BIGINT)) AS has_null,
                    count(*) FILTER (WHERE txn_id IS NULL) AS null_txn,
                    count(*) FILTER (WHERE payer_user_id IS NULL) AS null_payer,
                    count(*) FILTER (WHERE txn_id IS NULL OR created_at IS NULL OR updated_at IS NULL
                                     OR payer_user_id IS NULL OR merchant_id IS NULL) AS nulls
             FROM lake GROUP BY dt) l ON l.dt = s.dt)"""

ORACLES = {
    "dq_row_count": on_events(
        """SELECT dt, coalesce(s, 0) AS source_rows, coalesce(l, 0) AS lake_rows, coalesce(l, 0) - coalesce(s, 0) AS diff
           FROM (SELECT dt, count(*) AS s FROM transactions GROUP BY dt)
           FULL JOIN (SELECT dt, count(*) AS l FROM lake GROUP BY dt) USING (dt)
           WHERE coalesce(l, 0) <> coalesce(s, 0)""",
        _LAKE,
    ),
    "dq_not_null": on_events(
        "\nUNION ALL\n".join(
            f"""SELECT dt, count(*) AS rows, '{c}' AS column_name, count(*) - count({c}) AS null_rows
                FROM lake GROUP BY dt HAVING count(*) > count({c})"""
            for c in KEYS
        ),
        _LAKE,
    ),
    "dq_unique_key": """
        SELECT l_linestatus, count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
               count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates
        FROM lineitem GROUP BY l_linestatus""",
    "dq_partition_exists": """
        SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS dt
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
        WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "dq_freshness": on_payments(
        f"SELECT table_name, high_watermark, source_max_updated, {_FRESHNESS} AS verdict FROM marks", _MAXIMA
    ),
    "freshness_status": on_payments(
        f"""SELECT table_name, high_watermark, source_max_updated, lag_hours,
                   CASE WHEN lag_hours <= 26 THEN 'ok' ELSE 'stale' END AS status, CAST(26 AS BIGINT) AS limit_hours
            FROM (SELECT *, floor((date_diff('second', high_watermark, {_NOW}) + 180) / 360) / CAST(10 AS DOUBLE)
                    AS lag_hours FROM marks)""",
        _MAXIMA,
    ),
    "dq_schema_drift": on_payments(
        """SELECT 'transactions' AS table_name, 'device_id' AS column_name, 'added' AS drift, count(upi_ref) AS live_values
           FROM transactions
           UNION ALL SELECT 'transactions', 'failure_code', 'dropped', NULL
           UNION ALL SELECT 'refunds', 'amount_paise', 'type_changed', count(amount_paise) FROM refunds"""
    ),
    "dq_partition_gate": on_events(
        "SELECT 'transactions' AS table_name, dt, source_rows, lake_rows, failed_check FROM gated", f"{_LAKE}, {_GATE}"
    ),
    "reconcile_counts": on_events(
        """SELECT dt, coalesce(s, 0) AS source_rows, l AS lake_rows
           FROM (SELECT dt, count(*) AS s FROM transactions GROUP BY dt)
           FULL JOIN (SELECT dt, count(*) AS l FROM lake GROUP BY dt) USING (dt)
           WHERE l IS DISTINCT FROM coalesce(s, 0)""",
        _LAKE,
    ),
    "reconcile_recent": on_events(
        """SELECT 'transactions' AS table_name, dt, source_rows, lake_rows, failed_check,
             CASE failed_check
               WHEN 'row_count' THEN 'rows at the source ' || source_rows || ', in the lake ' || lake_rows || ': '
                    || CASE WHEN lake_rows > source_rows THEN '+' ELSE '' END || (lake_rows - source_rows)
               WHEN 'not_null' THEN CASE WHEN null_txn > 0 THEN 'txn_id' ELSE 'payer_user_id' END || ' is missing in '
                    || CASE WHEN null_txn > 0 THEN null_txn ELSE null_payer END || ' of ' || lake_rows || ' rows'
               WHEN 'unique_key' THEN 'txn_id repeats itself ' || (lake_rows - k) || ' times in ' || lake_rows || ' rows'
               ELSE 'the lake has no such day' END AS detail
           FROM gated
           WHERE failed_check IS NOT NULL
             AND CAST(dt AS DATE) > (SELECT max(CAST(created_at AS DATE)) FROM transactions) - 14""",
        f"{_LAKE}, {_GATE}",
    ),
    "curated_vs_source": on_payments(
        "\nUNION ALL\n".join(
            [
                f"SELECT 'daily_merchant_metrics' AS table_name, '{finding}' AS finding, {column} AS row_count FROM totals"
                for finding, column in [(c, c) for c in ("only_in_source", "only_in_lake", "matched")]
                + [(f"differs:{c}", f"d_{c}") for c in reconcile.METRIC_MEASURES]
            ]
            + [
                f"SELECT 'user_cohorts', '{finding}', count(*) FILTER (WHERE {test}) FROM user_cohorts"
                for finding, test in {
                    "only_in_source": "weeks_since_signup = 2",
                    "only_in_lake": "FALSE",
                    "matched": "weeks_since_signup <> 2",
                    "differs:cohort_size": "FALSE",
                    "differs:active_users": "weeks_since_signup = 4",
                }.items()
            ]
        ),
        f"""kept AS MATERIALIZED (SELECT * FROM daily_merchant_metrics),
            moved AS (SELECT *, row_number() OVER () AS nth FROM kept WHERE merchant_id = 7 AND dt < '1996-01-01'),
            totals AS MATERIALIZED (
              SELECT count(*) FILTER (WHERE merchant_id = 3 OR (merchant_id = 7 AND dt < '1996-01-01')) AS only_in_source,
                     (SELECT count(*) FROM moved WHERE nth = 1) AS only_in_lake,
                     count(*) FILTER (WHERE merchant_id <> 3 AND NOT (merchant_id = 7 AND dt < '1996-01-01')) AS matched,
                     count(*) FILTER (WHERE merchant_id = 5) AS d_txn_count,
                     {", ".join(f"CAST(0 AS BIGINT) AS d_{c}" for c in reconcile.METRIC_MEASURES if c != "txn_count")}
              FROM kept)""",
    ),
    "dq_report": on_events(
        f"""SELECT t.table_name, c.check_name,
                   CASE WHEN c.check_name = 'freshness' THEN CASE WHEN {_FRESHNESS} <> 'fresh' THEN 'fail' ELSE 'pass' END
                        WHEN c.check_name = 'schema_drift'
                          THEN CASE WHEN t.table_name = 'merchants' THEN 'fail' ELSE 'pass' END
                        WHEN t.table_name = 'users' THEN 'error'
                        WHEN t.table_name = 'transactions' AND c.check_name IN (
                          SELECT failed_check FROM gated WHERE dt = (SELECT max(dt) FROM transactions)) THEN 'fail'
                        ELSE 'pass' END AS status
            FROM order_marks t CROSS JOIN (SELECT unnest(['schema_drift', 'partition_exists', 'row_count',
                                                           'not_null', 'unique_key', 'freshness']) AS check_name) c""",
        f"""{_LAKE}, {_GATE}, order_marks AS (
              SELECT *, CASE table_name WHEN 'merchants' THEN NULL
                        WHEN 'transactions' THEN source_max_updated - INTERVAL 30 HOUR
                        ELSE source_max_updated END AS high_watermark
              FROM (SELECT 'users' AS table_name, max(updated_at) AS source_max_updated FROM users
                    UNION ALL SELECT 'merchants', max(updated_at) FROM merchants
                    UNION ALL SELECT 'transactions', max(o_orderdate + (o_orderkey % 6) * INTERVAL 1 DAY) FROM orders
                    UNION ALL SELECT 'refunds', max(updated_at) FROM refunds))""",
    ),
}
ORACLES["curated_vs_source_cells"] = ORACLES["curated_vs_source"]
