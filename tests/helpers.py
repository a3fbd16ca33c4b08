"""Small payments tables for tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.sources import catalog


def transactions(spark, days=4, per_day=50, start=datetime(2026, 8, 20)):
    """``per_day`` rows on each day; every tenth row changed two days later."""
    rows = []
    for i in range(days * per_day):
        created = start + timedelta(days=i // per_day, minutes=i % per_day)
        updated = created + timedelta(days=2 if i % 10 == 0 else 0)
        status = ("SUCCESS", "FAILED", "PENDING")[i % 3]
        code = "U30" if status == "FAILED" else None
        row = (i, str(400000000000 + i), i % 7, i % 5, 100 * i, status, code, created, updated)
        rows.append((*row, created.date().isoformat()))
    return spark.createDataFrame(rows, catalog.struct_type("transactions"))


def refunds(spark, tx):
    out = tx.filter(F.col("status") == "SUCCESS").select(
        (F.col("txn_id") * 10).alias("refund_id"),
        "txn_id",
        "amount_paise",
        F.when(F.col("txn_id") % 2 == 0, "PROCESSED").otherwise("REJECTED").alias("status"),
        F.lit("ITEM_RETURNED").alias("reason"),
        "created_at",
        "updated_at",
        "dt",
    )
    return out.unionByName(out.withColumn("refund_id", F.col("refund_id") + 1))


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)
