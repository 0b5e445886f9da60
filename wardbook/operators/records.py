"""Flattening arrays of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_records(
    df: DataFrame,
    array: str,
    fields: Mapping[str, Column | str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per array element, as the columns in ``fields`` (name to path or expression).

    Inside ``fields`` the element is the column ``record``. A null or empty array gives one
    row of nulls. ``keep`` names columns of the enclosing row to carry along.
    """
    exploded = df.select(*keep, F.explode_outer(array).alias("record"))
    return exploded.select(
        *keep,
        *[(F.col(source) if isinstance(source, str) else source).alias(name) for name, source in fields.items()],
    )
