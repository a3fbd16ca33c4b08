"""The relational source over JDBC: parallel snapshot reads and the changed-date probe."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(url: str, table: str, split_on: str, lower: int, upper: int, splits: int) -> dict[str, str]:
    """Options of a read that opens ``splits`` connections, each with its own range of ``split_on``."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": split_on,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(splits),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
        "preferTimestampNTZ": "true",
        "fetchsize": "10000",
    }


def read_source(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str,
    lower: int,
    upper: int,
    splits: int = 32,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Snapshot of a source table. Filters on it, such as a window on ``updated_at``, run in the database."""
    options = jdbc_options(url, table, split_on, lower, upper, splits) | (properties or {})
    return spark.read.format("jdbc").options(**options).load()


def in_range(column: Column, lo: datetime, hi: datetime) -> Column:
    """``column`` in the half-open window ``[lo, hi)``; a plain range, so it is pushed into the source."""
    ntz = "timestamp_ntz"
    return (column >= F.lit(lo).cast(ntz)) & (column < F.lit(hi).cast(ntz))


def in_window(df: DataFrame, lo: datetime, hi: datetime, column: str = "updated_at") -> DataFrame:
    return df.filter(in_range(F.col(column), lo, hi))
