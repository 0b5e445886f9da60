"""Typed values and quality flags of observations that arrive as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The value types that have a typed column, the text of an explicit zero and
# the days after a month's end from which a report counts as late.
NUMERIC_VALUE_TYPES = (
    "INTEGER", "INTEGER_POSITIVE", "INTEGER_ZERO_OR_POSITIVE", "NUMBER", "PERCENTAGE",
)
BOOLEAN_VALUE_TYPES = ("BOOLEAN",)
ZERO_TEXT = "0"
LATE_AFTER_DAYS = 60

TYPED_COLUMNS: Mapping[str, tuple[str, Sequence[str]]] = {
    "numeric_value": ("double", NUMERIC_VALUE_TYPES),
    "boolean_value": ("boolean", BOOLEAN_VALUE_TYPES),
}


def with_typed_values(
    df: DataFrame,
    value: str = "raw_value",
    value_type: str = "value_type",
    typed: Mapping[str, tuple[str, Sequence[str]]] = TYPED_COLUMNS,
) -> DataFrame:
    """Add one column per target type, filled where the row's value type belongs to it.

    Text that does not parse, an unlisted value type and a null value type give null.
    """
    return df.withColumns({
        name: F.when(F.col(value_type).isin(*names), F.col(value).try_cast(sql_type))
        for name, (sql_type, names) in typed.items()
    })


def with_quality_flags(
    df: DataFrame,
    value: str = "raw_value",
    updated: str = "last_updated_at",
    period_end: str = "period_end_date",
    late_after_days: int = LATE_AFTER_DAYS,
) -> DataFrame:
    """Add three-valued zero and late flags and a two-valued missing flag."""
    return df.withColumns({
        "is_explicit_zero": F.col(value) == ZERO_TEXT,
        "is_missing_value": F.col(value).isNull(),
        "is_late_reported": F.date_diff(updated, period_end) > late_after_days,
    })
