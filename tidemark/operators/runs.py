"""The run log of scheduled jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` runs per job, newest first, runs without a start last, ties by run id.

    Each map task keeps its ``n`` best per job before anything is shuffled (group limit of a ranking
    window), so a job with most of the log costs no more than any other.
    """
    order = Window.partitionBy("job").orderBy(F.col("start").desc_nulls_last(), F.col("run_id").desc())
    return runs.withColumn("recency", F.row_number().over(order)).filter(F.col("recency") <= n)


def run_state_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("job", "state").agg(F.count(F.lit(1)).alias("runs"))
