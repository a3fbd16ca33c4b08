"""The given tables seen as payments data. One SQL text serves both engines."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property, lru_cache
from string import Template

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import curated
from tidemark.plans.frames import Frames
from tidemark.session import scratch_path
from tidemark.sources import catalog
from tidemark.sources.lake import read_partitioned, write_partition_overwrite

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Payments from the order tables. Sign-up is the first order plus 30 days, so some activity precedes it.
ORDERS_AS_PAYMENTS = {
    "merchants": """
      SELECT s_suppkey AS merchant_id, s_name AS merchant_name, n_name AS category, n_name AS city,
             CASE WHEN s_suppkey % 10 = 0 THEN 'HIGH' WHEN s_suppkey % 10 <= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
             concat('+919', lpad(CAST(s_suppkey AS VARCHAR(20)), 9, '0')) AS contact_phone,
             $min_date + (s_suppkey % 30) * INTERVAL '1' DAY AS created_at,
             $min_date + (s_suppkey % 60) * INTERVAL '1' DAY AS updated_at,
             CAST(CAST($min_date + (s_suppkey % 30) * INTERVAL '1' DAY AS DATE) AS VARCHAR(10)) AS dt
      FROM $supplier JOIN $nation ON n_nationkey = s_nationkey""",
    "users": """
      SELECT c_custkey AS user_id, concat('Customer ', n_name) AS full_name,
             concat('+918', lpad(CAST(c_custkey AS VARCHAR(20)), 9, '0')) AS phone,
             concat('user', CAST(c_custkey AS VARCHAR(20)), '@example.org') AS email,
             concat('user', CAST(c_custkey AS VARCHAR(20)), '@upi') AS vpa,
             n_name AS city,
             CASE c_mktsegment WHEN 'BUILDING' THEN 'FULL_KYC' WHEN 'MACHINERY' THEN 'FULL_KYC'
                               WHEN 'FURNITURE' THEN 'REJECTED' ELSE 'MIN_KYC' END AS kyc_status,
             f.first_order + INTERVAL '30' DAY AS created_at,
             f.first_order + (30 + c_custkey % 6) * INTERVAL '1' DAY AS updated_at,
             CAST(CAST(f.first_order + INTERVAL '30' DAY AS DATE) AS VARCHAR(10)) AS dt
      FROM $customer JOIN $nation ON n_nationkey = c_nationkey
      JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM $orders GROUP BY o_custkey) f
        ON f.o_custkey = c_custkey""",
    "transactions": """
      SELECT o_orderkey AS txn_id, CAST(400000000000 + o_orderkey AS VARCHAR(20)) AS upi_ref,
             o_custkey AS payer_user_id, o_orderkey % (SELECT count(*) FROM $supplier) AS merchant_id,
             CAST(round(o_totalprice * 100) AS BIGINT) AS amount_paise,
             CASE o_orderstatus WHEN 'P' THEN 'PENDING' WHEN 'F' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
             CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS failure_code,
             o_orderdate AS created_at,
             o_orderdate + (o_orderkey % 6) * INTERVAL '1' DAY AS updated_at,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS dt
      FROM $orders""",
    "refunds": """
      SELECT ((l_orderkey * 10000000 + l_partkey) * 1000 + l_suppkey) * 10 + l_linenumber AS refund_id,
             l_orderkey AS txn_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_paise,
             CASE WHEN l_returnflag = 'A' THEN 'REJECTED' WHEN l_linestatus = 'F' THEN 'PROCESSED' ELSE 'PENDING' END
               AS status,
             CASE l_linenumber % 4 WHEN 0 THEN 'DUPLICATE_CHARGE' WHEN 1 THEN 'ITEM_RETURNED'
                  WHEN 2 THEN 'SERVICE_NOT_DELIVERED' ELSE 'WRONG_AMOUNT' END AS reason,
             l_shipdate AS created_at,
             l_shipdate + (l_orderkey % 6) * INTERVAL '1' DAY AS updated_at,
             CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) AS dt
      FROM $lineitem WHERE l_returnflag IN ('R', 'A')""",
}

# Transactions with times of day and late updates, from the events table.
EVENTS_AS_TRANSACTIONS = """
      SELECT event_id AS txn_id, CAST(400000000000 + event_id AS VARCHAR(20)) AS upi_ref, user_id AS payer_user_id,
             CAST(replace(replace(props, '{"k": ', ''), '}', '') AS BIGINT) AS merchant_id,
             CAST(round(value * 100) AS BIGINT) AS amount_paise,
             CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'PENDING' ELSE 'SUCCESS' END AS status,
             CASE WHEN event_type = 'error' THEN concat('U', CAST(event_id % 5 AS VARCHAR(2))) END AS failure_code,
             ts AS created_at, ts + (event_id % 6) * INTERVAL '1' DAY AS updated_at,
             CAST(CAST(ts AS DATE) AS VARCHAR(10)) AS dt
      FROM $events"""

CONTACT_TEXT = """
      SELECT c_custkey AS id,
             concat('parcel ', CAST(c_custkey AS VARCHAR(20)), ' of 1997-03-02: ring +918',
                    lpad(CAST(c_custkey AS VARCHAR(20)), 9, '0'), '; pays as user', CAST(c_custkey AS VARCHAR(20)),
                    '@upi; bill to user', CAST(c_custkey AS VARCHAR(20)), '@example.org; receipt ',
                    CAST(400000000000 + c_custkey AS VARCHAR(20))) AS text
      FROM $customer"""
CLEAN_CONTACT_TEXT = "concat('parcel ', id, ' of 1997-03-02: ring [PHONE]; pays as [VPA]; bill to [EMAIL]; receipt [UPI_REF]')"
CONTACT_FINDINGS = "PHONE,VPA,EMAIL,UPI_REF"

_CONSTANTS = {"min_date": "TIMESTAMP_NTZ '1995-01-01 00:00:00'"}
_DUCKDB_CONSTANTS = {"min_date": "TIMESTAMP '1995-01-01 00:00:00'"}


def duck(text: str) -> str:
    """Fixture text with the plain table names under which the checking engine knows the tables."""
    return Template(text).substitute({s: s for s in SOURCES} | _DUCKDB_CONSTANTS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _table(spark.sparkContext.applicationId, spark, sf_dir, name)


@lru_cache(maxsize=None)
def _table(app: str, spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run fixture text over the given tables through views of its own, so no other view is replaced."""
    return _fixture(spark.sparkContext.applicationId, spark, sf_dir, text)


@lru_cache(maxsize=None)
def _fixture(app: str, spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    prefix = "given_" + hashlib.md5(sf_dir.encode()).hexdigest()[:8]
    used = {s: f"{prefix}_{s}" for s in SOURCES if f"${s}" in text}
    for source, view in used.items():
        table(spark, sf_dir, source).createOrReplaceTempView(view)
    return spark.sql(Template(text).substitute(used | _CONSTANTS))


def payments(spark: SparkSession, sf_dir: str) -> Frames:
    """The four source tables from orders, lineitem, customer, supplier and nation.

    Only their definitions are kept between calls. What derives from them is planned anew for each
    query, so that no query is answered from the shuffle files of an earlier one.
    """
    return Frames(**_payments(spark.sparkContext.applicationId, spark, sf_dir))


@lru_cache(maxsize=None)
def _payments(app: str, spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = {
        name: catalog.conform(fixture(spark, sf_dir, text), name) for name, text in ORDERS_AS_PAYMENTS.items()
    }
    # The dimension is a stored table, as in the lake, so that the planner knows its size.
    path = scratch_path(spark, "merchants")
    write_partition_overwrite(frames["merchants"], path, "dt", ["merchant_id"])
    frames["merchants"] = read_partitioned(spark, path, catalog.struct_type("merchants"))
    return frames


@dataclass(frozen=True)
class _Stored(Frames):
    """Frames whose curated tables are written once per session, each when a query first reads it."""

    source: tuple[SparkSession, str] | None = None

    @cached_property
    def daily_merchant_metrics(self) -> DataFrame:
        return _metrics(self.source[0].sparkContext.applicationId, *self.source)

    @cached_property
    def user_cohorts(self) -> DataFrame:
        return _cohorts(self.source[0].sparkContext.applicationId, *self.source)


def curated_frames(spark: SparkSession, sf_dir: str) -> Frames:
    """The same with the curated tables as written ones, as views and charts read them."""
    base = payments(spark, sf_dir)
    return _Stored(base.users, base.merchants, base.transactions, base.refunds, source=(spark, sf_dir))


@lru_cache(maxsize=None)
def _metrics(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "daily_merchant_metrics")
    write_partition_overwrite(payments(spark, sf_dir).daily_merchant_metrics, path, "dt", ["merchant_id"])
    return read_partitioned(spark, path, catalog.struct_type("daily_merchant_metrics"))


@lru_cache(maxsize=None)
def _cohorts(app: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    f, path = payments(spark, sf_dir), scratch_path(spark, "user_cohorts")
    curated.write_cohorts(f.users, f.transactions, path)
    return read_partitioned(spark, path, catalog.struct_type("user_cohorts"))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.conform(fixture(spark, sf_dir, EVENTS_AS_TRANSACTIONS), "transactions")


def event_lake(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Path and frame of the event transactions as a partitioned table, written once per session."""
    return _event_lake(spark.sparkContext.applicationId, spark, sf_dir)


@lru_cache(maxsize=None)
def _event_lake(app: str, spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = scratch_path(spark, "transactions")
    write_partition_overwrite(event_transactions(spark, sf_dir), path, "dt", ["txn_id"])
    return path, read_partitioned(spark, path, catalog.struct_type("transactions"))


def event_frames(spark: SparkSession, sf_dir: str) -> Frames:
    """The stored event transactions next to users, merchants and refunds from the other tables."""
    base = payments(spark, sf_dir)
    return Frames(base.users, base.merchants, event_lake(spark, sf_dir)[1], base.refunds)


def contact_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, sf_dir, CONTACT_TEXT)


# ---------------------------------------------------------------- the same in the checking engine

_CURATED_SQL = """
attempts AS (
  SELECT merchant_id, dt, count(*) AS txn_count, count(*) FILTER (WHERE status = 'SUCCESS') AS success_count,
         count(*) FILTER (WHERE status = 'FAILED') AS failed_count, count(*) FILTER (WHERE status = 'PENDING') AS pending_count,
         CAST(sum(CASE status WHEN 'SUCCESS' THEN amount_paise ELSE 0 END) AS BIGINT) AS success_amount_paise
  FROM transactions GROUP BY ALL),
given_back AS (
  SELECT merchant_id, paid.dt, count(*) AS refund_count, CAST(sum(back.amount_paise) AS BIGINT) AS refund_amount_paise
  FROM refunds back JOIN transactions paid USING (txn_id) WHERE back.status IN ('PROCESSED', 'PENDING') GROUP BY ALL),
daily_merchant_metrics AS (
  SELECT attempts.* EXCLUDE (dt, merchant_id), dt, merchant_id, merchant_name, category,
         coalesce(refund_count, 0) AS refund_count, coalesce(refund_amount_paise, 0) AS refund_amount_paise
  FROM attempts LEFT JOIN given_back USING (dt, merchant_id)
       LEFT JOIN (SELECT merchant_id, merchant_name, category FROM merchants) USING (merchant_id)),
signups AS (SELECT user_id, CAST(date_trunc('week', created_at) AS DATE) AS began FROM users),
payer_weeks AS (
  SELECT DISTINCT payer_user_id AS user_id, CAST(date_trunc('week', created_at) AS DATE) AS week
  FROM transactions WHERE status = 'SUCCESS'),
user_cohorts AS (
  SELECT CAST((week - began) // 7 AS INTEGER) AS weeks_since_signup, cohort_size, count(*) AS active_users,
         CAST(began AS VARCHAR) AS cohort_week
  FROM payer_weeks JOIN signups USING (user_id)
       JOIN (SELECT began, count(*) AS cohort_size FROM signups GROUP BY began) USING (began)
  WHERE week >= began GROUP BY ALL),
daily_gmv AS (
  SELECT dt, CAST(sum(txn_count) AS BIGINT) AS txn_count, CAST(sum(success_count) AS BIGINT) AS success_count,
         CAST(sum(success_amount_paise) AS DOUBLE) / CAST(100.0 AS DOUBLE) AS gmv_rupees,
         CAST((20000 * CAST(sum(success_count) AS BIGINT) + CAST(sum(txn_count) AS BIGINT))
              // (2 * CAST(sum(txn_count) AS BIGINT)) AS DOUBLE) / CAST(100.0 AS DOUBLE) AS success_rate_pct
  FROM daily_merchant_metrics GROUP BY dt),
merchant_leaderboard AS (
  SELECT merchant_id, merchant_name, category, CAST(n AS BIGINT) AS txn_count,
         CAST(p AS DOUBLE) / CAST(100.0 AS DOUBLE) AS gmv_rupees,
         CAST((20000 * f + n) // (2 * n) AS DOUBLE) / CAST(100.0 AS DOUBLE) AS failure_rate_pct,
         CAST((20000 * r + nullif(s, 0)) // (2 * nullif(s, 0)) AS DOUBLE) / CAST(100.0 AS DOUBLE) AS refund_rate_pct
  FROM (SELECT merchant_id, merchant_name, category, CAST(sum(txn_count) AS BIGINT) AS n,
               CAST(sum(success_amount_paise) AS BIGINT) AS p, CAST(sum(failed_count) AS BIGINT) AS f,
               CAST(sum(refund_count) AS BIGINT) AS r, CAST(sum(success_count) AS BIGINT) AS s
        FROM daily_merchant_metrics GROUP BY 1, 2, 3)),
failure_reasons AS (
  SELECT dt, failure_code, count(*) AS failed_count FROM transactions WHERE status = 'FAILED' GROUP BY 1, 2),
retention_weekly AS (
  SELECT cohort_week, weeks_since_signup, cohort_size,
         CAST((20000 * active_users + cohort_size) // (2 * cohort_size) AS DOUBLE) / CAST(100.0 AS DOUBLE)
           AS retention_pct
  FROM user_cohorts)"""


def on_payments(body: str, extra: str = "") -> str:
    """``body`` over the payments fixtures, curated tables and views."""
    ctes = ",".join(f"{name} AS ({duck(text)})" for name, text in ORDERS_AS_PAYMENTS.items())
    return f"WITH {ctes},{_CURATED_SQL}{', ' + extra if extra else ''}\n{body}"


def on_events(body: str, extra: str = "") -> str:
    """``body`` over ``transactions`` from events, the other source tables, curated tables and views."""
    texts = ORDERS_AS_PAYMENTS | {"transactions": EVENTS_AS_TRANSACTIONS}
    ctes = ",".join(f"{name} AS ({duck(text)})" for name, text in texts.items())
    return f"WITH {ctes},{_CURATED_SQL}{', ' + extra if extra else ''}\n{body}"


def on_contacts(body: str, extra: str = "") -> str:
    return f"WITH contact_text AS ({duck(CONTACT_TEXT)}){', ' + extra if extra else ''}\n{body}"
