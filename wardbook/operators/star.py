"""The fact projection, its dimensions and the check of its grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what a missing partition value is called at rest.
UNKNOWN = "Unknown"


def project_fact(df: DataFrame, columns: Sequence[str] | Mapping[str, Column]) -> DataFrame:
    """The fact's columns in contract order, given as names or as name-to-expression."""
    if isinstance(columns, Mapping):
        return df.select(*[expression.alias(name) for name, expression in columns.items()])
    return df.select(*columns)


def fill_unknown(df: DataFrame, column: str, unknown: str = UNKNOWN) -> DataFrame:
    """Name the null; a value that has this name already, with or without ``_`` after it, gets one more ``_``."""
    value = F.col(column)
    named = F.when(value.rlike(f"^{unknown}_*$"), F.concat(value, F.lit("_"))).otherwise(value)
    return df.withColumn(column, F.coalesce(named, F.lit(unknown)))


def restore_unknown(df: DataFrame, column: str, unknown: str = UNKNOWN) -> DataFrame:
    """Undo ``fill_unknown``."""
    value = F.col(column)
    plain = F.when(value.rlike(f"^{unknown}_+$"), F.expr(f"left(`{column}`, char_length(`{column}`) - 1)")).otherwise(value)
    return df.withColumn(column, F.when(value != unknown, plain))


def ambiguous_keys(bridge: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that a join on ``bridge`` would multiply, with their row count.

    Checking the bridge finds what would break the fact's grain without shuffling the fact.
    """
    return (
        bridge.dropna(subset=list(keys)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    )
