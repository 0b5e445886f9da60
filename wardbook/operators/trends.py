"""Monthly totals, change against the month before, rolling means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.functions.columns import month_index, ratio
from wardbook.operators.trailing import HotKeyRanges, HotKeySplit, over_trailing_rows


def period_totals(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str | Column,
    total: str = "monthly_value",
) -> DataFrame:
    """Sum of ``value`` per key and period. Leaves one row per key and month for any window."""
    return df.groupBy(*keys, period).agg(F.sum(value).alias(total))


def period_change(
    totals: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str = "monthly_value",
    previous: str = "previous_month_value",
    change: str = "mom_percent_change",
    calendar: bool = False,
) -> DataFrame:
    """Previous period's value and the percent change from it, null unless it is positive.

    ``totals`` has one row per key and period. The previous row counts as the previous
    period, whatever the gap; ``calendar`` looks at the month before and nothing else.
    """
    by_key = Window.partitionBy(*keys)
    if calendar:
        month_before = by_key.orderBy(month_index(F.col(period))).rangeBetween(-1, -1)
        earlier = F.max(value).over(month_before)
    else:
        earlier = F.lag(value).over(by_key.orderBy(period))
    with_earlier = totals.withColumn(previous, earlier)
    return with_earlier.withColumn(
        change, ratio(F.col(value) - F.col(previous), F.col(previous)) * 100
    )


def rolling_mean(
    totals: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str = "monthly_value",
    mean: str = "rolling_3_month_avg",
    periods: int = 3,
    min_periods: int = 1,
    calendar: bool = False,
    split: HotKeySplit | HotKeyRanges | None = None,
) -> DataFrame:
    """Mean of the row and the ``periods - 1`` rows before it.

    Fewer than ``min_periods`` non-null values give null. ``calendar`` takes the last
    ``periods`` months instead of rows.
    """
    measures = {mean: F.avg(value), "__present": F.count(value)}
    if calendar:
        window = (
            Window.partitionBy(*keys).orderBy(month_index(F.col(period))).rangeBetween(1 - periods, 0)
        )
        rolled = totals.withColumns({n: m.over(window) for n, m in measures.items()})
    else:
        rolled = over_trailing_rows(totals, keys, [period], 1 - periods, 0, measures, split)
    return rolled.withColumn(
        mean, F.when(F.col("__present") >= min_periods, F.col(mean))
    ).drop("__present")
