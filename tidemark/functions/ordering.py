"""Positions in a total order, computed without bringing a group or a result into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed


def _range_sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Sort over all tasks and remember for each row its task and its place in it.

    The frame is checkpointed: both numbers depend on sampled range bounds and must not be computed
    twice.
    """
    low_bits = F.lit((1 << 33) - 1)
    return checkpointed(
        df.sort(*order).withColumns(
            {
                "_part": F.spark_partition_id(),
                "_place": F.monotonically_increasing_id().bitwiseAND(low_bits),
            }
        )
    )


def numbered(df: DataFrame, order: list[Column], position: str) -> DataFrame:
    """Add the zero-based position of each row in the given order.

    Each task numbers its own rows; the offset it starts from is the number of rows of the tasks before
    it, one figure per task.
    """
    rows = _range_sorted(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    # One offset per task: bounded by the number of shuffle partitions.
    joined = rows.join(F.broadcast(offsets), "_part")
    return joined.withColumn(position, F.col("_before") + F.col("_place")).drop("_part", "_place", "_before")


def values_at(
    df: DataFrame, value: str, by: list[str], positions: dict[str, Column]
) -> DataFrame:
    """Exact order statistics: per group, the value at each zero-based position of its sorted values.

    ``positions`` are expressions over ``n``, the number of non-null values of the group. Equal values
    combine on the map side. The distinct ones are sorted by group and value over all tasks, so a group
    of any size and any distribution is spread out; running counts exist per task and group, and only the
    tasks' shares that hold a wanted position are looked into.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_copies"))
    rows = _range_sorted(counted, [F.col(c) for c in (*by, value)])
    shares = rows.groupBy(*by, "_part").agg(F.sum("_copies").alias("_share"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        *by,
        "_part",
        "_share",
        F.coalesce(F.sum("_share").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_share").over(group).alias("n"),
    )
    wanted = [F.struct(F.lit(k).alias("name"), at.cast("bigint").alias("at")) for k, at in positions.items()]
    targets = (
        shares.select(*by, "_part", "_share", "_before", "n", F.explode(F.array(*wanted)).alias("w"))
        .filter((F.col("w.at") >= F.col("_before")) & (F.col("w.at") < F.col("_before") + F.col("_share")))
        .select(*by, "_part", "_before", "n", "w.name", "w.at")
    )
    inside = rows.join(targets, [*by, "_part"])
    running = Window.partitionBy(*by, "name").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("_upto", F.col("_before") + F.sum("_copies").over(running)).filter(
        F.col("_upto") > F.col("at")
    )
    names = list(positions)
    return reached.groupBy(*by, "n").pivot("name", names).agg(F.min(value)).select(*by, "n", *names)
