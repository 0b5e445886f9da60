"""Comparisons across areas and countries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.functions.columns import month_index

# The score below which a month is low, and the months in a row that make a streak.
LOW_SCORE = 0.80
MIN_STREAK = 3

NULL_COLUMN = "null"


def volumes(
    df: DataFrame,
    by: Sequence[str],
    value: str | Column = "numeric_value",
    total: str = "total_service_volume",
    additive: Column | None = None,
) -> DataFrame:
    """Sum of ``value`` per group, sorted by it. ``additive`` limits the sum to rows it holds for."""
    measure = F.col(value) if isinstance(value, str) else value
    if additive is not None:
        measure = F.when(additive, measure)
    return df.groupBy(*by).agg(F.sum(measure).alias(total)).orderBy(*by)


def distinct_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values to use as output columns, null first; a table's width bounds them."""
    rows = df.select(column).distinct().collect()
    return sorted((r[0] for r in rows), key=lambda v: (v is not None, v))


def coverage_pairs(df: DataFrame, row: str, column: str, *more: str) -> DataFrame:
    """The pairs that occur, one row each: the matrix's ones in a form that any number of columns fits."""
    return df.select(row, column, *more).distinct()


def coverage_matrix(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """One row per ``row`` value, a 0/1 column per entry of ``values``.

    A null entry is named ``null``, with ``_`` after it while a value has that name. A plain
    aggregate: it folds before the single shuffle and needs no job to find columns.
    """
    null = NULL_COLUMN
    while null in {str(v) for v in values if v is not None}:
        null += "_"
    return df.groupBy(row).agg(*[
        F.max(F.col(column).eqNullSafe(F.lit(v)).cast("int")).alias(null if v is None else str(v))
        for v in values
    ])


def low_streaks(
    scores: DataFrame,
    group: Sequence[str],
    period: str = "period",
    score: str = "avg_completeness_score",
    below: float = LOW_SCORE,
    at_least: int = MIN_STREAK,
    index: Column | None = None,
) -> DataFrame:
    """Runs of ``at_least`` consecutive periods scoring under ``below``, sorted.

    ``scores`` has one row per group and period. ``index`` numbers the periods without gaps;
    by default it counts the months of a ``yyyyMM`` period.
    """
    numbered = scores.filter(F.col(score) < below).withColumn(
        "__index", month_index(F.col(period)) if index is None else index
    )
    order = Window.partitionBy(*group).orderBy("__index")
    return (
        numbered.withColumn("__island", F.col("__index") - F.row_number().over(order))
        .groupBy(*group, "__island")
        .agg(
            F.count(F.lit(1)).alias("consecutive_low_periods"),
            F.min(period).alias("streak_start_period"),
            F.max(period).alias("streak_end_period"),
            F.avg(score).alias("avg_streak_completeness"),
        )
        .filter(F.col("consecutive_low_periods") >= at_least)
        .drop("__island")
        .orderBy(*group, "streak_start_period")
    )
