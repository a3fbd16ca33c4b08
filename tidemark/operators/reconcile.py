"""Source-to-lake reconciliation and comparison of curated tables with independently computed ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import day
from tidemark.operators.quality import partition_gate, rows_per_day
from tidemark.session import small_frame


def reconcile_counts(source: DataFrame, manifest: DataFrame) -> DataFrame:
    """Every partition whose source count differs from the manifest, lake-only partitions included.

    This finds rows the incremental window never saw and partitions whose source rows are gone.
    ``lake_rows`` is null where the lake has no partition.
    """
    src = rows_per_day(source).withColumnRenamed("rows", "source_rows")
    lake = manifest.select("dt", F.col("rows").alias("lake_rows"))
    both = src.join(lake, "dt", "full_outer").select(
        "dt", F.coalesce("source_rows", F.lit(0).cast("bigint")).alias("source_rows"), "lake_rows"
    )
    return both.filter(~F.col("source_rows").eqNullSafe(F.col("lake_rows")))


def reconcile_recent(
    source: DataFrame, lake: DataFrame, table: str, lookback_days: int = 14, reference: date | None = None
) -> DataFrame:
    """The partition gate over dates after ``reference - lookback_days``, all failures collected.

    Without a reference the newest creation date of the source is used. It is fetched first, one row,
    so that the range becomes a literal that prunes the lake and is pushed into the source.
    """
    newest = reference or source.agg(F.max(F.col("created_at").cast("date")).alias("d")).first()["d"]
    if newest is None:
        return partition_gate(source, lake, table)
    floor = F.date_sub(F.lit(newest), lookback_days)
    recent_source = source.filter(F.col("created_at") >= F.date_add(floor, 1).cast("timestamp_ntz"))
    recent_lake = lake.filter(F.col("dt") > floor.cast("string"))
    return partition_gate(recent_source, recent_lake, table)


def compare_tables(
    expected: DataFrame, actual: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """Outer comparison on ``keys``: one row per finding kind with its number of rows.

    Kinds: ``only_in_source``, ``only_in_lake``, ``differs:<column>`` and ``matched``, the number of keys
    on both sides. Comparison is null-safe. Both inputs are aggregates with unique keys, so the join
    has no hot key.
    """
    e = expected.select(*keys, *[F.col(c).alias(f"e_{c}") for c in columns], F.lit(True).alias("in_e"))
    a = actual.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("in_a"))
    joined = e.join(a, keys, "full_outer")
    both = F.col("in_e").isNotNull() & F.col("in_a").isNotNull()
    counts = {
        "only_in_source": F.col("in_a").isNull(),
        "only_in_lake": F.col("in_e").isNull(),
        "matched": both,
        **{f"differs:{c}": both & ~F.col(f"e_{c}").eqNullSafe(F.col(f"a_{c}")) for c in columns},
    }
    totals = joined.agg(*[F.count_if(condition).alias(name) for name, condition in counts.items()])
    return totals.unpivot([], [f"`{name}`" for name in counts], "finding", "row_count")


# Sides of the grid of key buckets whose checksums are compared first.
GRID = 64
_WEIGHTS = (1 << 31) - 1


def _cell(keys: list[str]) -> Column:
    """Bucket of a row: one of GRID by the first key next to one of GRID by the second."""
    first, second = (F.pmod(F.xxhash64(F.col(k)), F.lit(GRID)).cast("int") for k in keys)
    return first * GRID + second


def _weight(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit("weight")), F.lit(_WEIGHTS))


def _weighted(value: Column) -> Column:
    return F.sum(F.col("w").cast("decimal(11,0)") * value.cast("decimal(20,0)"))


def source_checksums(transactions: DataFrame, refunds: DataFrame) -> DataFrame:
    """``cell`` and, per measure of the metrics, the sum of weight times value over its keys.

    Every measure adds up over payments or refunds, so does its weighted sum: payments go straight into their cell, and
    no key is grouped. Refunds look up day and merchant of their payment.
    """
    pay = transactions.select("txn_id", "status", "amount_paise", *METRIC_KEYS)
    pay = pay.withColumns({"cell": _cell(METRIC_KEYS), "w": _weight(METRIC_KEYS)})

    def times(state: str | None) -> Column:
        return F.sum("w" if state is None else F.when(F.col("status") == state, F.col("w")))

    counted = pay.groupBy("cell").agg(
        times(None).alias("txn_count"),
        times("SUCCESS").alias("success_count"),
        times("FAILED").alias("failed_count"),
        times("PENDING").alias("pending_count"),
        _weighted(F.when(F.col("status") == "SUCCESS", F.col("amount_paise"))).alias("success_amount_paise"),
        F.max(F.greatest(*[F.col(k).isNull() for k in METRIC_KEYS])).alias("doubtful"),
    )
    back = refunds.filter(F.col("status") != "REJECTED").select("txn_id", F.col("amount_paise").alias("back"))
    given = (
        pay.select("txn_id", "cell", "w")
        .join(back, "txn_id")
        .groupBy("cell")
        .agg(F.sum("w").alias("refund_count"), _weighted(F.col("back")).alias("refund_amount_paise"))
    )
    return _checksums(counted.unionByName(given, allowMissingColumns=True))


def lake_checksums(metrics: DataFrame) -> DataFrame:
    """The same of the stored rows, with their number. Doubtful are cells with repeated or null keys, null measures, or rows
    that no payment can have made."""
    held = metrics.select(*METRIC_KEYS, *METRIC_MEASURES).withColumns(
        {"cell": _cell(METRIC_KEYS), "w": _weight(METRIC_KEYS)}
    )
    odd = F.greatest(*[F.col(c).isNull() for c in (*METRIC_KEYS, *METRIC_MEASURES)], F.col("txn_count") < 1)
    per_key = held.groupBy("cell", "w", *METRIC_KEYS).agg(
        *[F.sum(m).alias(m) for m in METRIC_MEASURES],
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.max(odd), F.lit(True)).alias("odd"),
    )
    return _checksums(
        per_key.groupBy("cell").agg(
            *[_weighted(F.col(m)).alias(m) for m in METRIC_MEASURES],
            F.sum("rows").alias("rows"),
            F.max(F.col("odd") | (F.col("rows") > 1)).alias("doubtful"),
        )
    )


def _checksums(df: DataFrame) -> DataFrame:
    kind, zero = "decimal(38,0)", F.lit(0).cast("decimal(38,0)")
    rows = [F.sum("rows").alias("rows")] if "rows" in df.columns else []
    sums = [F.coalesce(F.sum(F.col(m).cast(kind)), zero).cast(kind).alias(m) for m in METRIC_MEASURES]
    return df.groupBy("cell").agg(*sums, *rows, F.coalesce(F.max("doubtful"), F.lit(False)).alias("doubtful"))


def compare_metrics(transactions: DataFrame, refunds: DataFrame, metrics: DataFrame) -> DataFrame:
    """The findings of :func:`compare_tables` between the metrics by definition and the stored ones.

    Checksums of GRID * GRID cells are compared first; rows are grouped and joined only in cells that differ or are in doubt,
    so equal tables cost one aggregate of each side and no join of their rows. Values that differ escape with a chance of one
    in 2**31, where the weighted differences of a cell cancel out.
    """
    spark = transactions.sparkSession
    source, lake = source_checksums(transactions, refunds), lake_checksums(metrics)
    same = F.lit(True)
    for m in METRIC_MEASURES:
        same = same & F.col(f"s_{m}").eqNullSafe(F.col(f"l_{m}"))
    s, at = (df.select("cell", *[F.col(c).alias(f"{x}_{c}") for c in df.columns[1:]]) for df, x in ((source, "s"), (lake, "l")))
    doubt = F.coalesce("s_doubtful", F.lit(False)) | F.coalesce("l_doubtful", F.lit(False))
    # One row per cell: at most GRID * GRID.
    cells = s.join(at, "cell", "full_outer").select("cell", (same & ~doubt).alias("same"), F.coalesce("l_rows", F.lit(0)).alias("n"))
    found = cells.collect()
    matched = sum(r["n"] for r in found if r["same"])
    differing = [r["cell"] for r in found if not r["same"]]
    columns = METRIC_KEYS, METRIC_MEASURES
    if not differing:
        kinds = ["only_in_source", "only_in_lake", "matched", *[f"differs:{m}" for m in METRIC_MEASURES]]
        rows = [(k, matched if k == "matched" else 0) for k in kinds]
        return small_frame(spark, rows, "finding string, row_count bigint")
    inside = _cell(METRIC_KEYS).isin(differing)
    rest = compare_tables(metrics_by_sql(transactions.filter(inside), refunds), metrics.filter(inside), *columns)
    return rest.withColumn("row_count", F.col("row_count") + F.when(F.col("finding") == "matched", matched).otherwise(0))


METRIC_KEYS, COHORT_KEYS = ["dt", "merchant_id"], ["cohort_week", "weeks_since_signup"]
METRIC_MEASURES = [
    "txn_count", "success_count", "failed_count", "pending_count", "success_amount_paise", "refund_count",
    "refund_amount_paise",
]
COHORT_MEASURES = ["cohort_size", "active_users"]


def metrics_by_sql(transactions: DataFrame, refunds: DataFrame) -> DataFrame:
    """The metrics from their definition, independent of how the curated table is computed."""
    return transactions.sparkSession.sql(
        """
        WITH each AS (
          SELECT pay.*, back.times, back.paise
          FROM {pay} pay LEFT JOIN LATERAL (
            SELECT count(*) AS times, sum(b.amount_paise) AS paise FROM {back} b
            WHERE b.txn_id = pay.txn_id AND b.status NOT IN ('REJECTED')) back)
        SELECT dt, merchant_id, sum(1L) AS txn_count, sum(if(status = 'SUCCESS', 1L, 0L)) AS success_count,
               sum(if(status = 'FAILED', 1L, 0L)) AS failed_count, sum(if(status = 'PENDING', 1L, 0L)) AS pending_count,
               sum(if(status = 'SUCCESS', amount_paise, 0L)) AS success_amount_paise,
               sum(coalesce(times, 0L)) AS refund_count, sum(coalesce(paise, 0L)) AS refund_amount_paise
        FROM each GROUP BY ALL""",
        pay=transactions.select("txn_id", "dt", "merchant_id", "status", "amount_paise"),
        back=refunds,
    )


def cohorts_by_sql(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """The cohorts from their definition: distinct payers per sign-up week and week of activity."""
    return users.sparkSession.sql(
        """
        WITH joined AS (SELECT user_id, CAST(date_trunc('week', created_at) AS DATE) AS began FROM {people}),
        paying AS (SELECT payer_user_id AS user_id, CAST(date_trunc('week', created_at) AS DATE) AS week
                   FROM {pay} WHERE status = 'SUCCESS' GROUP BY ALL),
        kept AS (SELECT began, week, count(*) AS n FROM paying JOIN joined USING (user_id) WHERE week >= began GROUP BY ALL)
        SELECT CAST(began AS STRING) AS cohort_week, CAST(datediff(week, began) / 7 AS INT) AS weeks_since_signup,
               members AS cohort_size, n AS active_users
        FROM kept JOIN (SELECT began, count(*) AS members FROM joined GROUP BY began) USING (began)""",
        people=users.select("user_id", "created_at"),
        pay=transactions.select("payer_user_id", "created_at", "status"),
    )


def curated_vs_source(
    users: DataFrame,
    in_scope: DataFrame,
    transactions: DataFrame,
    refunds: DataFrame,
    metrics: DataFrame,
    cohorts: DataFrame,
    cells: bool = True,
) -> DataFrame:
    """Both curated tables against the source: ``table_name, finding, row_count``.

    ``in_scope`` are the payments of the days that ``metrics`` holds; cohorts are compared over all payments. With ``cells``,
    metrics are compared by checksums first, which pays where tables are large and as a rule equal; without, all their rows
    meet at once, which is faster for a table of some million rows or one that is computed anew for every scan.
    """
    if cells:
        metrics_found = compare_metrics(in_scope, refunds, metrics)
    else:
        metrics_found = compare_tables(metrics_by_sql(in_scope, refunds), metrics, METRIC_KEYS, METRIC_MEASURES)
    parts = {
        "daily_merchant_metrics": metrics_found,
        "user_cohorts": compare_tables(
            cohorts_by_sql(users, transactions), cohorts, COHORT_KEYS, COHORT_MEASURES
        ),
    }
    tagged = [df.select(F.lit(name).alias("table_name"), "finding", "row_count") for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1])


def source_days(source: DataFrame) -> DataFrame:
    return source.select(day("created_at").alias("dt")).distinct()
