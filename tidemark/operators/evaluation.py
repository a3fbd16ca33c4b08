"""Comparing result sets and summarising question-answering runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.expr import mean
from tidemark.functions.ordering import numbered


def _normal_value(name: str, dtype: T.DataType) -> Column:
    """Numbers with two decimals, everything else as text, null as a word of its own."""
    column = F.col(f"`{name}`")
    if isinstance(dtype, T.NumericType):
        text = F.format_string("%.2f", column.cast("double"))
    else:
        text = column.cast("string")
    return F.when(column.isNull(), F.lit("None")).otherwise(text)


def normal_rows(df: DataFrame) -> DataFrame:
    """One array ``row`` per row with its normalised values in sorted order.

    Column names and order are irrelevant by design, and so is which column a value stands in: the rows
    (1, 2) and (2, 1) are equal.
    """
    values = [_normal_value(f.name, f.dataType) for f in df.schema.fields]
    return df.select(F.array_sort(F.array(*values)).alias("row"))


def _verdict(differences: DataFrame) -> DataFrame:
    """One row even for no differences at all."""
    return differences.agg(
        (F.coalesce(F.sum("differs"), F.lit(0)) == 0).alias("equal"),
        F.coalesce(F.sum("differs"), F.lit(0)).cast("bigint").alias("differing_rows"),
    )


def multiset_equal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Compare two results as bags of rows. Copies are counted per side before the sides meet."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return normal_rows(df).groupBy("row").agg(F.count(F.lit(1)).alias(name))

    joined = counted(left, "l").join(counted(right, "r"), "row", "full_outer")
    zero = F.lit(0).cast("bigint")
    return _verdict(
        joined.select(F.abs(F.coalesce("l", zero) - F.coalesce("r", zero)).alias("differs"))
    )


def _numbered(df: DataFrame, order: list[Column], columns: list[str], side: str) -> DataFrame:
    values = [_normal_value(f.name, f.dataType) for f in df.select(*columns).schema.fields]
    return numbered(df, order, "_pos").select("_pos", F.array_sort(F.array(*values)).alias(side))


def ordered_equal(
    left: DataFrame,
    right: DataFrame,
    left_order: list[Column],
    right_order: list[Column],
    columns: list[str] | None = None,
) -> DataFrame:
    """Compare two ordered results position by position."""
    l_rows = _numbered(left, left_order, columns or left.columns, "l")
    r_rows = _numbered(right, right_order, columns or right.columns, "r")
    joined = l_rows.join(r_rows, "_pos", "full_outer")
    return _verdict(joined.select((~F.col("l").eqNullSafe(F.col("r"))).cast("bigint").alias("differs")))


def order_only_difference(
    left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column]
) -> DataFrame:
    """Both verdicts side by side; ``order_only`` marks results that differ in nothing but row order."""
    strict = ordered_equal(left, right, left_order, right_order).select(F.lit("strict").alias("kind"), "equal")
    bag = multiset_equal(left, right).select(F.lit("bag").alias("kind"), "equal")
    verdicts = strict.unionByName(bag).agg(
        F.max(F.when(F.col("kind") == "strict", F.col("equal"))).alias("equal_in_order"),
        F.max(F.when(F.col("kind") == "bag", F.col("equal"))).alias("equal_as_bag"),
    )
    return verdicts.withColumn("order_only", F.col("equal_as_bag") & ~F.col("equal_in_order"))


# What a guard message contains, and the outcome it stands for, first match wins.
GUARD_REASONS = (
    ("does not parse", "guard:sql_syntax"),
    ("LIMIT", "guard:missing_or_bad_limit"),
    ("partitioned", "guard:missing_partition_filter"),
    ("PII", "guard:pii_column"),
    ("SELECT *", "guard:select_star"),
    ("allow-list", "guard:unknown_table"),
    ("qualified", "guard:unqualified_table"),
    ("EXPLAIN failed", "guard:explain_failed_bad_column_or_type"),
    ("estimated scan", "guard:cost_gate"),
)


def classify_outcomes(records: DataFrame) -> DataFrame:
    """Add ``outcome``, the first bucket that applies.

    Records: ``error, guard_ok, guard_errors, exec_error, correct, gold_tables, retrieved, used_tables``.
    """
    errors = F.concat_ws(" ", "guard_errors")
    guard = F.lit("guard:other")
    for text, name in reversed(GUARD_REASONS):
        guard = F.when(F.contains(errors, F.lit(text)), name).otherwise(guard)
    missed = F.size(F.array_except("gold_tables", "retrieved")) > 0
    other_tables = (F.size(F.array_except("gold_tables", "used_tables")) > 0) | (
        F.size(F.array_except("used_tables", "gold_tables")) > 0
    )
    wrong = (
        F.when(missed, "wrong_result:retrieval_missed_a_gold_table")
        .when(other_tables, "wrong_result:wrong_table_choice")
        .otherwise("wrong_result:same_tables_wrong_logic")
    )
    # An empty message counts as no error.
    outcome = (
        F.when(F.length("error") > 0, "pipeline_error")
        .when(~F.coalesce("guard_ok", F.lit(False)), guard)
        .when(F.length("exec_error") > 0, "execution_error")
        .when(~F.coalesce("correct", F.lit(False)), wrong)
        .otherwise("correct")
    )
    return records.withColumn("outcome", outcome)


def eval_summary(classified: DataFrame) -> DataFrame:
    """Long-form summary: accuracy, correct out of total per difficulty, questions per outcome.

    ``classified`` has ``difficulty, outcome, first_attempt_ok, elapsed_ms``. Questions are aggregated
    once, by both groupings, and all figures come from that small result. Rows: ``section, item, n,
    total, value``, the last two null for outcomes, which are counts.
    """
    ok = F.col("outcome") == "correct"
    per_pair = classified.groupBy("difficulty", "outcome").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(ok).alias("ok"),
        F.count_if("first_attempt_ok").alias("first"),
        F.sum("elapsed_ms").alias("ms"),
    )
    overall = per_pair.agg(
        F.sum("n").alias("total"),
        F.sum("ok").alias("ok"),
        F.sum("first").alias("first"),
        F.sum("ms").alias("ms"),
    )

    def line(section: str, item: Column, n: Column, total: Column, value: Column) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            item.alias("item"),
            n.cast("bigint").alias("n"),
            total.cast("bigint").alias("total"),
            value.cast("double").alias("value"),
        )

    total = F.col("total")

    def share(n: Column) -> Column:
        return F.round(mean(n, total), 3)

    seconds = F.round(mean(F.col("ms"), total) / 1000, 1)
    lines = F.array(
        line("overall", F.lit("execution_accuracy"), F.col("ok"), total, share(F.col("ok"))),
        line("overall", F.lit("first_attempt"), F.col("first"), total, share(F.col("first"))),
        line("overall", F.lit("mean_seconds"), total, total, seconds),
    )
    totals = overall.select(F.explode(lines).alias("x"))
    by_difficulty = (
        per_pair.groupBy("difficulty")
        .agg(F.sum("n").alias("total"), F.sum("ok").alias("ok"))
        .select(line("difficulty", F.col("difficulty"), F.col("ok"), total, share(F.col("ok"))).alias("x"))
    )
    none = F.lit(None)
    by_outcome = (
        per_pair.groupBy("outcome")
        .agg(F.sum("n").alias("n"))
        .select(line("outcome", F.col("outcome"), F.col("n"), none, none).alias("x"))
    )
    return totals.unionByName(by_difficulty).unionByName(by_outcome).select("x.*")
