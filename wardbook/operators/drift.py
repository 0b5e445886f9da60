"""What was added, removed or renamed between two snapshots of a register."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.operators.latest import latest_by

CHANGES = ("added", "removed", "renamed")


def snapshot_drift(
    current: DataFrame, reference: DataFrame, key: str, name: str, order: Sequence[str] = ()
) -> DataFrame:
    """``id``, ``change``, ``old_name`` and ``new_name`` of each id that differs.

    An id listed more than once counts once, by the greatest of ``order`` and then of the
    name. Only names are compared; a name that was or became null counts as changed. Entries
    without an id are nobody's and are left out. Both sides come out of their deduplication
    partitioned by id, and the join needs no further shuffle.
    """
    def side(df: DataFrame, prefix: str) -> DataFrame:
        narrow = df.filter(F.col(key).isNotNull()).select(key, name, *order)
        one = latest_by(narrow, [key], order)
        return one.select(
            F.col(key).alias(f"{prefix}_id"), F.col(name).alias(f"{prefix}_name"),
            F.lit(True).alias(f"in_{prefix}"),
        )

    old, new = side(reference, "old"), side(current, "new")
    both = new.join(old, F.col("new_id") == F.col("old_id"), "full_outer")
    change = (
        F.when(F.col("in_old").isNull(), F.lit("added"))
        .when(F.col("in_new").isNull(), F.lit("removed"))
        .when(~F.col("old_name").eqNullSafe(F.col("new_name")), F.lit("renamed"))
    )
    return both.select(
        F.coalesce("new_id", "old_id").alias("id"), change.alias("change"), "old_name", "new_name"
    ).filter(F.col("change").isNotNull())


def drift_totals(drift: DataFrame) -> DataFrame:
    """One row with the number of added, removed and renamed ids."""
    return drift.agg(*[
        F.count_if(F.col("change") == change).alias(f"total_{change}") for change in CHANGES
    ])
