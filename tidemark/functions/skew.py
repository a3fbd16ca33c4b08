"""Equi-joins whose left side may hold a hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: Column, how: str = "inner", salts: int = 16
) -> DataFrame:
    """Join ``left`` to ``right``, spreading each key of ``left`` over ``salts`` shuffle partitions.

    ``right`` must be the smaller side with few rows per key: it is repeated once per salt. The salt is a
    hash of ``spread_by``, not a random number, so a task that is run again sends every row to the same
    place. Results are those of the plain join. A right side that Spark measures as small enough is
    broadcast instead, and the salt then costs nothing but its repetition.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"salting the left side cannot answer a {how} join")
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")
