"""One deterministic row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return isinstance(data_type, T.AtomicType) and not isinstance(data_type, T.VariantType)


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order`` columns per key, nulls last.

    Equal rows are told apart by ``ties`` and, if none are given, by all other columns, so a
    retried task picks the same row again. Null keys form a group of their own.

    The filter on ``row_number`` lets Spark keep one row per key and map task before the
    shuffle, so a key holding a third of the rows sends one row per task and no more.
    """
    if ties is None:
        ties = [
            f.name for f in df.schema.fields
            if f.name not in {*keys, *order} and _orderable(f.dataType)
        ]
    ranking: list[Column] = [F.col(c).desc_nulls_last() for c in [*order, *ties]]
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*ranking))
    return df.withColumn("__position", position).filter("__position = 1").drop("__position")


def unique_lookup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A lookup or dimension with one row per key, the greatest by its other columns."""
    return latest_by(df, keys, order=[])
