"""Choosing the periods of an export that still have to be loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.functions.columns import join_null_safe


def period_digests(df: DataFrame, columns: Sequence[str], period: str = "period") -> DataFrame:
    """``(period, rows, digest, check)`` per period: equal for equal sets of rows, in whatever order they come.

    Rows are compared in ``columns`` only. They fold before the shuffle to one row per period and task.
    """
    of_row = [F.lit(1), *[F.col(c) for c in columns]]
    return df.groupBy(period).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*of_row).cast("decimal(20,0)")).cast("string").alias("digest"),
        F.bit_xor(F.xxhash64(F.lit(2), *[F.col(c) for c in reversed(columns)])).alias("check"),
    )


def differing_periods(offered: DataFrame, held: DataFrame, period: str = "period") -> DataFrame:
    """``(period, is_loaded)`` of the offered periods that are not held, or held with another digest."""
    known = held.select(
        period, F.lit(True).alias("is_loaded"), *[F.col(c).alias(f"__{c}") for c in ("rows", "digest", "check")])
    same = (F.col("rows") == F.col("__rows")) & (F.col("digest") == F.col("__digest")) & (F.col("check") == F.col("__check"))
    return (
        offered.filter(F.col(period).isNotNull()).join(known, period, "left").filter(~F.coalesce(same, F.lit(False)))
        .select(period, F.coalesce("is_loaded", F.lit(False)).alias("is_loaded"))
    )


def new_periods_only(
    df: DataFrame,
    loaded: DataFrame,
    period: str = "period",
    loaded_period: str = "year_month",
    updated: str = "last_updated_at",
    reprocess_corrected: bool = False,
    key: Sequence[str] = (),
) -> DataFrame:
    """Rows whose period is not among the loaded ones; rows without a period are left out.

    With ``reprocess_corrected`` a loaded period comes back whole, all its rows, if it offers a
    key that is not loaded, whatever its time stamp, or a newer row of one that is. Keys are
    compared one by one, as a late report may carry an older stamp than others of its period.
    Both sides fold to one row per key before they meet.
    """
    df = df.filter(F.col(period).isNotNull())
    if not reprocess_corrected:
        skipped = loaded.select(F.col(loaded_period).alias(period)).distinct()
        return df.join(skipped, period, "left_anti")
    offered = df.groupBy(period, *key).agg(F.max(updated).alias("__offered"))
    held = (
        loaded.withColumnRenamed(loaded_period, period).groupBy(period, *key)
        .agg(F.max(updated).alias("__held"), F.lit(True).alias("__is_held"))
    )
    newer = F.col("__is_held").isNull() | (
        F.col("__offered").isNotNull() & F.coalesce(F.col("__offered") > F.col("__held"), F.lit(True))
    )
    changed = join_null_safe(offered, held, [period, *key], "left").filter(newer).select(period).distinct()
    return df.join(changed, period, "left_semi")
