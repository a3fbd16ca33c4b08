"""Curated tables, views, ad-hoc questions and charts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import cohorts, curated
from tidemark.operators.ingest import Lake
from tidemark.plans import charts
from tidemark.plans import questions as q
from tidemark.session import scratch_path
from tidemark.sources import catalog
from workload.fixtures import curated_frames, event_frames, event_lake, on_events, on_payments, payments

# Dates the questions ask about: order dates run from 1995 to 2001, events through January 2024.
DAY, OTHER_DAY, LAST_DAY = "1997-05-23", "1997-05-25", "1997-05-31"
FIRST, LAST = "1997-05-01", "1997-05-28"
SINCE = "1997-05-01"
SIGNUP_DAY, SIGNUP_FIRST, SIGNUP_LAST = "1995-02-13", "1995-02-01", "1995-02-28"
COHORT, COHORT_FIRST, COHORT_LAST = "1995-03-13", "1995-02-06", "1995-06-26"
MERCHANT = 63
BUSY = 100
E_DAY, E_FIRST, E_LAST = "2024-01-15", "2024-01-09", "2024-01-15"
E_DAY_AFTER = "2024-01-16"

METRIC_COLUMNS = ", ".join(catalog.table("daily_merchant_metrics").column_names)


def _p(fn):
    return lambda spark, sf_dir: fn(payments(spark, sf_dir))


def _c(fn):
    return lambda spark, sf_dir: fn(curated_frames(spark, sf_dir))


def _e(fn):
    return lambda spark, sf_dir: fn(event_frames(spark, sf_dir))


def _lake(fn):
    return lambda spark, sf_dir: fn(event_lake(spark, sf_dir)[1])


def transform_range(spark, sf_dir):
    """Two runs over overlapping ranges; the metric partitions that both left behind."""
    f = payments(spark, sf_dir)
    lake = Lake(spark, scratch_path(spark, "curated-lake"))
    for end in (date(1997, 5, 24), date(1997, 5, 28)):
        curated.transform(f.users, f.merchants, f.transactions, f.refunds, lake, end)
    return lake.curated("daily_merchant_metrics")


def transform_cohorts(spark, sf_dir):
    """The cohorts that a run leaves behind, next to the rows its statistics know of each week."""
    f = payments(spark, sf_dir)
    lake = Lake(spark, scratch_path(spark, "curated-lake"))
    curated.transform(f.users, f.merchants, f.transactions, f.refunds, lake, date(1997, 5, 28))
    known = lake.manifest("user_cohorts").select(F.col("dt").alias("cohort_week"), "rows")
    return lake.curated("user_cohorts").join(known, "cohort_week", "left")


def user_cohorts_incremental(spark, sf_dir):
    """The cohorts that a first run and a run over the last days leave behind.

    At the time of the first run some payments of those days were not settled, and some users not known.
    """
    f = payments(spark, sf_dir)
    lake = Lake(spark, scratch_path(spark, "cohort-lake"))
    first, last = date(2001, 7, 20), date(2001, 8, 31)
    unsettled = (F.col("dt") >= first.isoformat()) & (F.col("txn_id") % 2 == 0)
    early = f.transactions.filter("dt < '2001-07-30'").withColumn("status", F.when(unsettled, "PENDING").otherwise(F.col("status")))
    cohorts.refresh_cohorts(f.users.filter("user_id % 10 <> 3"), early, lake)
    cohorts.refresh_cohorts(f.users, f.transactions, lake, first, last)
    return lake.curated("user_cohorts")


def transform_range_bucketed(spark, sf_dir):
    """A range of metrics over payments and refunds that are stored for their join."""
    f = payments(spark, sf_dir)
    lake = Lake(spark, scratch_path(spark, "bucketed-lake"))
    mark = lake.root.rsplit("-", 1)[-1][:12]
    copies = curated.JoinCopies(f"payments_by_txn_{mark}", f"refunds_by_txn_{mark}", lake.root, 8)
    curated.store_join_copies(f.transactions, f.refunds, copies)
    path = lake.curated_path("daily_merchant_metrics")
    for end in (date(1997, 5, 24), date(1997, 5, 28)):
        curated.transform_range(f.transactions, f.refunds, f.merchants, path, end, copies=copies)
    return lake.curated("daily_merchant_metrics")


QUERIES = {
    "refunds_per_txn": _p(lambda f: curated.refunds_per_txn(f.refunds)),
    "daily_merchant_metrics": _p(lambda f: f.daily_merchant_metrics),
    "user_cohorts": _p(lambda f: f.user_cohorts),
    "transform_range": transform_range,
    "transform_cohorts": transform_cohorts,
    "user_cohorts_incremental": user_cohorts_incremental,
    "transform_range_bucketed": transform_range_bucketed,
    "daily_gmv": _c(lambda f: f.daily_gmv),
    "merchant_leaderboard": _c(lambda f: f.merchant_leaderboard),
    "failure_reasons": _p(lambda f: f.failure_reasons),
    "retention_weekly": _c(lambda f: f.retention_weekly),
    "q_count_filter": _p(lambda f: q.count_filter(f, DAY, OTHER_DAY, LAST_DAY, SIGNUP_DAY, SIGNUP_FIRST, SIGNUP_LAST)),
    "q_view_point": _c(lambda f: q.view_point(f, DAY, COHORT)),
    "q_view_range_sorted": _c(lambda f: q.view_range_sorted(f, FIRST, LAST, COHORT_FIRST)),
    "q_argmax": _c(lambda f: q.argmax(f, OTHER_DAY, FIRST, LAST, BUSY)),
    "q_topn_view": _c(q.topn_view),
    "q_count_distinct": _c(lambda f: q.count_distinct(f, DAY)),
    "q_range_sum": _c(lambda f: q.range_sum(f, FIRST, LAST, MERCHANT)),
    "q_view_point_sorted": _p(lambda f: q.view_point_sorted(f, OTHER_DAY)),
    "q_group_top": _c(lambda f: q.group_top(f, FIRST, LAST)),
    "q_avg_filter": _c(lambda f: q.avg_filter(f, DAY, COHORT_FIRST, COHORT_LAST)),
    "q_group_count": _p(lambda f: q.group_count(f, LAST_DAY, FIRST, LAST)),
    "q_group_sum_sorted": _c(lambda f: q.group_sum_sorted(f, DAY)),
    "q_hour_histogram": _e(lambda f: q.hour_histogram(f, E_DAY)),
    "q_join_group": _e(lambda f: q.join_group(f, E_DAY)),
    "q_ratio_distinct": _e(lambda f: q.ratio_distinct(f, E_DAY)),
    "q_join_group_distinct": _e(lambda f: q.join_group_distinct(f, E_DAY)),
    "q_join_rate": _e(lambda f: q.join_rate(f, E_DAY)),
    "q_max_filter": _e(lambda f: q.max_filter(f, E_DAY)),
    "q_category_day_gmv": _p(q.category_day_gmv),
    "q_scan_full": _lake(q.scan_full),
    "q_scan_day": _lake(lambda tx: q.scan_day(tx, E_DAY)),
    "q_scan_week": _lake(lambda tx: q.scan_week(tx, E_FIRST, E_LAST)),
    "q_scan_nonpartition": _lake(lambda tx: q.scan_nonpartition(tx, E_DAY, E_DAY_AFTER)),
    "q_select_star": _lake(lambda tx: q.select_star(tx, E_FIRST, E_LAST)),
    "q_select_two": _lake(lambda tx: q.select_two(tx, E_FIRST, E_LAST)),
    "q_status_rollup": _lake(lambda tx: q.status_rollup(tx, E_FIRST, E_LAST)),
    "q_cte_block": _c(lambda f: q.cte_block(f, [OTHER_DAY, DAY, LAST_DAY], SINCE)),
    "chart_total_gmv": _c(lambda f: charts.total_gmv(f, SINCE)),
    "chart_daily_gmv": _c(lambda f: charts.daily_gmv(f, SINCE)),
    "chart_daily_success_rate": _c(lambda f: charts.daily_success_rate(f, SINCE)),
    "chart_top_merchants": _c(charts.top_merchants),
    "chart_failure_codes": _p(lambda f: charts.failure_codes(f, SINCE)),
    "chart_retention_heatmap": _c(charts.retention_cells),
}

_D100 = "CAST(100.0 AS DOUBLE)"


def _union(parts: dict[int, str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT CAST({i} AS BIGINT) AS question_id, x.* FROM ({s}) x" for i, s in parts.items())


def _top(source: str, key: str, measure: str, k: int, name: str = "value", kind: str = "DOUBLE") -> str:
    return (
        f"SELECT {key} AS key, CAST({measure} AS {kind}) AS {name} FROM {source} ORDER BY {name} DESC, key LIMIT {k}"
    )


def _counts(source: str, key: str) -> str:
    return f"SELECT {key} AS key, count(*) AS n FROM {source} GROUP BY 1"


def _mean(total: str, count: str) -> str:
    return f"CAST(CAST({total} AS BIGINT) AS DOUBLE) / CAST(CAST({count} AS BIGINT) AS DOUBLE)"


_IN = f"dt BETWEEN '{FIRST}' AND '{LAST}'"
_SIGNED_UP = f"dt BETWEEN '{SIGNUP_FIRST}' AND '{SIGNUP_LAST}'"
_TOTALS = "count(*) AS n, CAST(sum(amount_paise) AS BIGINT) AS paise"
_TX_COLUMNS = ", ".join(catalog.table("transactions").column_names)
_E_IN = f"dt BETWEEN '{E_FIRST}' AND '{E_LAST}'"


ORACLES = {
    "refunds_per_txn": on_payments(
        """SELECT txn_id, count(*) AS refund_count, CAST(sum(amount_paise) AS BIGINT) AS refund_amount_paise
           FROM refunds WHERE status <> 'REJECTED' GROUP BY txn_id"""
    ),
    "daily_merchant_metrics": on_payments(f"SELECT {METRIC_COLUMNS} FROM daily_merchant_metrics"),
    "user_cohorts": on_payments(
        "SELECT weeks_since_signup, cohort_size, active_users, cohort_week FROM user_cohorts"
    ),
    "transform_range": on_payments(
        f"SELECT {METRIC_COLUMNS} FROM daily_merchant_metrics WHERE dt BETWEEN '1997-05-17' AND '1997-05-28'"
    ),
    "transform_range_bucketed": on_payments(
        f"SELECT {METRIC_COLUMNS} FROM daily_merchant_metrics WHERE dt BETWEEN '1997-05-17' AND '1997-05-28'"
    ),
    "user_cohorts_incremental": on_payments(
        "SELECT weeks_since_signup, cohort_size, active_users, cohort_week FROM user_cohorts"
    ),
    "transform_cohorts": on_payments(
        """SELECT weeks_since_signup, cohort_size, active_users, cohort_week, count(*) OVER (PARTITION BY cohort_week) AS rows
           FROM user_cohorts"""
    ),
    "daily_gmv": on_payments("SELECT * FROM daily_gmv"),
    "merchant_leaderboard": on_payments("SELECT * FROM merchant_leaderboard"),
    "failure_reasons": on_payments("SELECT * FROM failure_reasons"),
    "retention_weekly": on_payments("SELECT * FROM retention_weekly"),
    "q_count_filter": on_payments(
        _union(
            {
                1: f"SELECT count(*) AS n FROM transactions WHERE dt = '{DAY}'",
                2: f"SELECT count(*) AS n FROM transactions WHERE dt = '{OTHER_DAY}' AND status = 'FAILED'",
                15: "SELECT count(*) AS n FROM merchants WHERE risk_tier = 'HIGH'",
                24: f"SELECT count(*) AS n FROM refunds WHERE dt = '{DAY}' AND status = 'PROCESSED'",
                26: f"SELECT count(*) AS n FROM transactions WHERE dt = '{LAST_DAY}' AND status = 'PENDING'",
                27: f"SELECT count(*) AS n FROM transactions WHERE dt = '{DAY}' AND amount_paise > 1000000",
                39: f"SELECT count(*) AS n FROM users WHERE dt = '{SIGNUP_DAY}'",
                40: f"SELECT count(*) AS n FROM users WHERE kyc_status = 'FULL_KYC' AND {_SIGNED_UP}",
            }
        )
    ),
    "q_view_point": on_payments(
        _union(
            {
                3: f"SELECT gmv_rupees AS value FROM daily_gmv WHERE dt = '{DAY}'",
                20: f"""SELECT retention_pct AS value FROM retention_weekly
                        WHERE cohort_week = '{COHORT}' AND weeks_since_signup = 1""",
            }
        )
    ),
    "q_view_range_sorted": on_payments(
        _union(
            {
                4: f"SELECT dt AS key, success_rate_pct AS value FROM daily_gmv WHERE {_IN}",
                22: f"""SELECT cohort_week AS key, CAST(cohort_size AS DOUBLE) AS value FROM retention_weekly
                        WHERE weeks_since_signup = 0 AND cohort_week >= '{COHORT_FIRST}'""",
                29: f"""SELECT dt AS key, success_rate_pct AS value FROM daily_gmv
                        WHERE {_IN} AND success_rate_pct < 92""",
            }
        )
    ),
    "q_argmax": on_payments(
        _union(
            {
                5: _top(f"daily_gmv WHERE {_IN}", "dt", "gmv_rupees", 1),
                18: _top(f"merchant_leaderboard WHERE txn_count > {BUSY}", "merchant_name", "failure_rate_pct", 1),
                36: _top(f"daily_merchant_metrics WHERE dt = '{OTHER_DAY}'", "merchant_name", "failed_count", 1),
            }
        )
    ),
    "q_topn_view": on_payments(
        "SELECT merchant_name, gmv_rupees FROM merchant_leaderboard ORDER BY gmv_rupees DESC, merchant_name LIMIT 5"
    ),
    "q_count_distinct": on_payments(
        f"SELECT count(DISTINCT merchant_id) AS n FROM daily_merchant_metrics WHERE dt = '{DAY}'"
    ),
    "q_range_sum": on_payments(
        _union(
            {
                8: f"SELECT CAST(sum(refund_amount_paise) AS DOUBLE) / {_D100} AS value FROM daily_merchant_metrics WHERE {_IN}",
                28: f"SELECT round(sum(gmv_rupees), 2) AS value FROM daily_gmv WHERE {_IN}",
                34: f"SELECT CAST(sum(refund_count) AS DOUBLE) AS value FROM daily_merchant_metrics WHERE {_IN}",
                38: f"""SELECT CAST(sum(success_amount_paise) AS DOUBLE) / {_D100} AS value
                        FROM daily_merchant_metrics WHERE merchant_id = {MERCHANT} AND {_IN}""",
            }
        )
    ),
    "q_view_point_sorted": on_payments(
        f"""SELECT failure_code, failed_count FROM failure_reasons WHERE dt = '{OTHER_DAY}'
            ORDER BY failed_count DESC, failure_code"""
    ),
    "q_group_top": on_payments(
        _union(
            {
                10: _top(f"failure_reasons WHERE {_IN} GROUP BY 1", "failure_code", "sum(failed_count)", 1, "n", "BIGINT"),
                17: _top(
                    f"daily_merchant_metrics WHERE {_IN} GROUP BY 1", "category", "sum(failed_count)", 3, "n", "BIGINT"
                ),
                19: _top(
                    f"daily_merchant_metrics WHERE {_IN} GROUP BY 1", "merchant_name", "sum(refund_count)", 1, "n", "BIGINT"
                ),
            }
        )
    ),
    "q_avg_filter": on_payments(
        _union(
            {
                11: f"""SELECT {_mean("sum(amount_paise)", "count(*)")} / {_D100} AS value FROM transactions
                        WHERE dt = '{DAY}' AND status = 'SUCCESS'""",
                21: f"""SELECT {_mean("sum(CAST(round(retention_pct * 100) AS BIGINT))", "count(*)")} / {_D100} AS value
                        FROM retention_weekly WHERE weeks_since_signup = 1
                        AND cohort_week BETWEEN '{COHORT_FIRST}' AND '{COHORT_LAST}'""",
            }
        )
    ),
    "q_group_count": on_payments(
        _union(
            {
                12: _counts("users", "city"),
                13: _counts("users", "kyc_status"),
                14: _counts("merchants", "category"),
                25: _counts(f"refunds WHERE {_IN}", "reason"),
                37: _counts(f"transactions WHERE dt = '{LAST_DAY}'", "status"),
            }
        )
    ),
    "q_group_sum_sorted": on_payments(
        f"""SELECT category, CAST(sum(success_amount_paise) AS DOUBLE) / {_D100} AS gmv FROM daily_merchant_metrics
            WHERE dt = '{DAY}' GROUP BY category ORDER BY gmv DESC, category"""
    ),
    "q_hour_histogram": on_events(
        f"""SELECT CAST(hour(created_at) AS INTEGER) AS h, count(*) AS n FROM transactions WHERE dt = '{E_DAY}'
            GROUP BY 1 ORDER BY 1"""
    ),
    "q_join_group": on_events(
        f"""SELECT m.category, count(*) AS n FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id
            WHERE t.dt = '{E_DAY}' GROUP BY m.category ORDER BY n DESC, m.category"""
    ),
    "q_ratio_distinct": on_events(
        f"""SELECT {_mean("count(*)", "count(DISTINCT payer_user_id)")} AS avg_payments
            FROM transactions WHERE dt = '{E_DAY}'"""
    ),
    "q_join_group_distinct": on_events(
        f"""SELECT u.city, count(DISTINCT t.payer_user_id) AS n FROM transactions t
            JOIN users u ON u.user_id = t.payer_user_id
            WHERE t.dt = '{E_DAY}' GROUP BY u.city ORDER BY n DESC, u.city"""
    ),
    "q_join_rate": on_events(
        f"""SELECT m.risk_tier, CAST((20000 * count(*) FILTER (WHERE t.status = 'SUCCESS') + count(*))
              // (2 * count(*)) AS DOUBLE) / {_D100} AS success_rate
            FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id
            WHERE t.dt = '{E_DAY}' GROUP BY m.risk_tier"""
    ),
    "q_max_filter": on_events(
        f"SELECT CAST(max(amount_paise) AS DOUBLE) / {_D100} AS max_rupees FROM transactions WHERE dt = '{E_DAY}'"
    ),
    "q_category_day_gmv": on_payments(
        f"""SELECT m.category, CAST(t.created_at AS DATE) AS d, count(*) AS n,
                   CAST(sum(t.amount_paise) AS DOUBLE) / {_D100} AS gmv
            FROM transactions t JOIN merchants m ON m.merchant_id = t.merchant_id
            WHERE t.status = 'SUCCESS' GROUP BY 1, 2"""
    ),
    "q_scan_full": on_events(f"SELECT {_TOTALS} FROM transactions"),
    "q_scan_day": on_events(f"SELECT {_TOTALS} FROM transactions WHERE dt = '{E_DAY}'"),
    "q_scan_week": on_events(f"SELECT {_TOTALS} FROM transactions WHERE {_E_IN}"),
    "q_scan_nonpartition": on_events(
        f"""SELECT {_TOTALS} FROM transactions
            WHERE created_at >= TIMESTAMP '{E_DAY} 00:00:00' AND created_at < TIMESTAMP '{E_DAY_AFTER} 00:00:00'"""
    ),
    "q_select_star": on_events(f"SELECT {_TX_COLUMNS} FROM transactions WHERE {_E_IN}"),
    "q_select_two": on_events(f"SELECT txn_id, amount_paise FROM transactions WHERE {_E_IN}"),
    "q_status_rollup": on_events(f"SELECT status, {_TOTALS} FROM transactions WHERE {_E_IN} GROUP BY status"),
    "q_cte_block": on_payments(
        f"""SELECT p.merchant_id, p.n, coalesce(x.failed, 0) AS failed FROM
              (SELECT merchant_id, CAST(sum(txn_count) AS BIGINT) AS n FROM daily_merchant_metrics
               WHERE dt >= '{SINCE}' GROUP BY merchant_id) p
            LEFT JOIN (SELECT merchant_id, count(*) AS failed FROM transactions
               WHERE dt IN ('{OTHER_DAY}', '{DAY}', '{LAST_DAY}') AND status = 'FAILED' GROUP BY merchant_id) x
              ON x.merchant_id = p.merchant_id
            ORDER BY p.n DESC, p.merchant_id LIMIT 5"""
    ),
    "chart_total_gmv": on_payments(f"SELECT round(sum(gmv_rupees), 2) AS gmv FROM daily_gmv WHERE dt >= '{SINCE}'"),
    "chart_daily_gmv": on_payments(
        f"SELECT dt, sum(gmv_rupees) AS gmv FROM daily_gmv WHERE dt >= '{SINCE}' GROUP BY dt ORDER BY dt"
    ),
    "chart_daily_success_rate": on_payments(
        f"""SELECT dt, {_mean("sum(CAST(round(success_rate_pct * 100) AS BIGINT))", "count(*)")} / {_D100} AS success_rate
            FROM daily_gmv WHERE dt >= '{SINCE}' GROUP BY dt ORDER BY dt"""
    ),
    "chart_top_merchants": on_payments(
        """SELECT merchant_name, category, txn_count, gmv_rupees, failure_rate_pct, refund_rate_pct
           FROM merchant_leaderboard ORDER BY gmv_rupees DESC, merchant_name LIMIT 10"""
    ),
    "chart_failure_codes": on_payments(
        f"""SELECT failure_code, CAST(sum(failed_count) AS BIGINT) AS failed FROM failure_reasons
            WHERE dt >= '{SINCE}' GROUP BY failure_code ORDER BY failed DESC, failure_code"""
    ),
    "chart_retention_heatmap": on_payments(
        """SELECT cohort_week, weeks_since_signup, max(retention_pct) AS retention_pct FROM retention_weekly
           GROUP BY 1, 2 ORDER BY 1, 2"""
    ),
}
