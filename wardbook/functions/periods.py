"""Monthly period strings and the columns derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The monthly period format.
PERIOD_PATTERN = r"^\d{6}$"
PERIOD_DATE_FORMAT = "yyyyMMdd"

PERIOD_COLUMNS = [
    "period", "year_month", "year", "month", "quarter", "period_start_date", "period_end_date",
]


def is_period(period: Column, strict: bool = False) -> Column:
    """True for six digits; ``strict`` also asks for a month from 01 to 12. Null stays null."""
    shaped = period.rlike(PERIOD_PATTERN)
    if not strict:
        return shaped
    return shaped & F.substring(period, 5, 2).between("01", "12")


def period_of(date: Column) -> Column:
    """The ``yyyyMM`` period a date or timestamp falls in."""
    return F.date_format(date, "yyyyMM")


def with_period_columns(df: DataFrame, period: str = "period") -> DataFrame:
    """Add year, month, quarter and the first and last day of a ``yyyyMM`` column.

    A month such as 13 leaves the dates and the quarter null and raises nothing, whatever
    the session's ANSI setting.
    """
    text = F.col(period)
    start = F.try_to_date(F.concat(text, F.lit("01")), PERIOD_DATE_FORMAT)
    year = F.substring(text, 1, 4).try_cast("int")
    return df.withColumns({
        "year": year,
        "month": F.substring(text, 5, 2).try_cast("int"),
        "year_month": text,
        "period_start_date": start,
        "period_end_date": F.last_day(start),
        "quarter": F.concat(year.cast("string"), F.lit("Q"), F.quarter(start).cast("string")),
    })


def period_dimension(df: DataFrame, period: str = "period") -> DataFrame:
    """One row per distinct period. The distinct runs on the bare string before deriving columns."""
    months = df.select(F.col(period).alias("period")).distinct()
    return with_period_columns(months).select(*PERIOD_COLUMNS)
