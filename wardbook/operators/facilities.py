"""Reporting rates, under-reporting ranks and value anomalies of reporting units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardbook.functions.columns import join_null_safe, ratio
from wardbook.operators.trailing import HotKeyRanges, HotKeySplit, over_trailing_rows


def reporting_rate(
    df: DataFrame,
    group: str = "country_name",
    period: str = "period",
    unit: str = "org_unit_uid",
    value: str = "raw_value",
    expected_units: DataFrame | None = None,
    keep_null_group: bool = False,
) -> DataFrame:
    """Units with any value per group and period, divided by the group's units.

    A group's units are those seen in ``df``, or in ``expected_units`` if given. The null
    group has no rate and is left out unless ``keep_null_group``. Rows first fold to one per
    unit and period, before any shuffle, and both counts are taken from that.
    """
    presence = df.groupBy(group, unit, period).agg(F.max(F.col(value).isNotNull()).alias("__has"))
    reported = (
        presence.filter("__has").groupBy(group, period).agg(F.count(unit).alias("reported_facilities"))
    )
    # Reading __has here too keeps both branches alike, so Spark shuffles the rows once.
    seen = presence.filter(F.col("__has").isNotNull()) if expected_units is None else expected_units
    expected = seen.groupBy(group).agg(F.count_distinct(unit).alias("expected_facilities"))
    joined = (
        join_null_safe(reported, expected, [group]) if keep_null_group else reported.join(expected, group)
    )
    return joined.select(
        group,
        period,
        "expected_facilities",
        "reported_facilities",
        ratio(F.col("reported_facilities"), F.col("expected_facilities")).alias("reporting_rate"),
    )


def top_underreporting(
    df: DataFrame,
    area: str = "health_area",
    unit: Sequence[str] = ("country_name", "facility_name", "org_unit_uid"),
    period: str = "period",
    value: str = "numeric_value",
    top: int = 5,
) -> DataFrame:
    """Units with the most periods whose values sum to zero, per area, to rank ``top`` with ties.

    A missing value counts as zero; a period without rows does not count. The rank comes from
    a count of units per number of zero periods: no task ever holds all units of an area,
    not even where all of them tie.
    """
    per_unit = (
        df.groupBy(area, *unit, period)
        .agg((F.sum(F.coalesce(F.col(value), F.lit(0))) == 0).cast("int").alias("__zero"))
        .groupBy(area, *unit)
        .agg(F.sum("__zero").alias("zero_data_periods"))
    )
    ahead = (
        Window.partitionBy(area).orderBy(F.col("zero_data_periods").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        per_unit.groupBy(area, "zero_data_periods")
        .agg(F.count(F.lit(1)).alias("__units"))
        .withColumn("rank", (F.coalesce(F.sum("__units").over(ahead), F.lit(0)) + 1).cast("int"))
        .filter(F.col("rank") <= top)
        .drop("__units")
    )
    # A handful of rows per area, found by counts: far smaller than the units they are met with.
    return join_null_safe(per_unit, ranks, [area, "zero_data_periods"]).select(
        area, *unit, "zero_data_periods", "rank"
    )


def rolling_anomalies(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str = "numeric_value",
    rows: int = 12,
    deviations: float = 3,
    exclude_current: bool = False,
    split: HotKeySplit | HotKeyRanges | None = None,
) -> DataFrame:
    """Rows more than ``deviations`` sample standard deviations off their trailing mean.

    The window is the row and the ``rows - 1`` before it; as the row takes part, no key with
    fewer than 11 values can exceed 3 deviations. ``exclude_current`` takes the ``rows``
    before it instead. Adds ``rolling_mean``, ``rolling_stddev`` and ``z_score``.
    """
    start, end = (-rows, -1) if exclude_current else (1 - rows, 0)
    measures = {"rolling_mean": F.avg(value), "rolling_stddev": F.stddev(value)}
    scored = over_trailing_rows(df, keys, order, start, end, measures, split)
    offset = F.col(value) - F.col("rolling_mean")
    spread = F.col("rolling_stddev")
    return scored.filter((spread > 0) & (F.abs(offset) > deviations * spread)).withColumn(
        "z_score", offset / spread
    )
