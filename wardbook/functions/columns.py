"""Small helpers for null-safe joins and unique lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key; the right key columns are dropped."""
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    condition: Column = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__right_{k}"]) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"__right_{k}" for k in keys])


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double where ``whole`` is positive, else null."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def month_index(period: Column) -> Column:
    """Months since year 0 of a ``yyyyMM`` string, so that neighbouring months differ by one."""
    return F.substring(period, 1, 4).try_cast("int") * 12 + F.substring(period, 5, 2).try_cast("int")
