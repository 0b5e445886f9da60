"""Splitting malformed rows off, and the gates that count them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from wardbook.errors import QuarantineRateExceeded
from wardbook.functions.periods import is_period

# Fixed value: the share of malformed rows above which a run stops.
MAX_QUARANTINE_RATE = 0.10


def with_validity(
    df: DataFrame,
    required: Sequence[str],
    period: str,
    strict: bool = False,
    flag: str = "is_valid",
) -> DataFrame:
    """Add a never-null flag: all ``required`` columns and the period are there, and it is a period."""
    present = [F.col(c).isNotNull() for c in [*required, period]]
    rule: Column = reduce(lambda a, b: a & b, present) & is_period(F.col(period), strict)
    return df.withColumn(flag, F.coalesce(rule, F.lit(False)))


def split_valid(df: DataFrame, flag: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """Valid and malformed rows; together they are the input and they share no row."""
    return df.filter(F.col(flag)).drop(flag), df.filter(~F.col(flag)).drop(flag)


def validity_summary(df: DataFrame, flag: str = "is_valid") -> DataFrame:
    """Total, malformed and valid rows and the malformed share, from one pass. No rows: share 1."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~F.col(flag)).alias("malformed_rows"),
        F.count_if(F.col(flag)).alias("valid_rows"),
    )
    return counts.withColumn(
        "quarantine_rate",
        F.when(F.col("total_rows") > 0, F.col("malformed_rows").cast("double") / F.col("total_rows"))
        .otherwise(F.lit(1.0)),
    )


def enforce_rate(summary: DataFrame | Row, limit: float = MAX_QUARANTINE_RATE) -> dict:
    """Raise if the malformed share of a ``validity_summary`` exceeds ``limit``; return its row otherwise."""
    row = (summary.first() if isinstance(summary, DataFrame) else summary).asDict()
    if row["quarantine_rate"] > limit:
        raise QuarantineRateExceeded(
            f"{row['malformed_rows']} of {row['total_rows']} rows are malformed,"
            f" more than the allowed share of {limit}"
        )
    return row


def dq_summary(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named stage, in one job."""
    return reduce(DataFrame.unionByName, [count_stages(df, {name: F.lit(True)}) for name, df in stages.items()])


def count_stages(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows of ``df`` per named condition, from one pass: ``(stage, rows)``."""
    counts = df.agg(F.array(*[
        F.struct(F.lit(name).alias("stage"), F.count_if(condition).alias("rows")) for name, condition in stages.items()
    ]).alias("counts"))
    return counts.select(F.inline("counts"))
