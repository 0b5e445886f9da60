"""How a register's attributes change over time: a log of changes, validity intervals, as-of joins.

The log has a row per change of an attribute, ``(id, attribute, value, is_present, changed_at)``;
an entry that leaves the register has ``is_present`` false. A run appends what differs from the
log's state and rewrites nothing. Values are kept as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.operators.latest import latest_by

LOG = ["id", "attribute", "value", "is_present", "changed_at"]


def attribute_rows(register: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """``(id, attribute, value)``: one row per entry and attribute. Entries without an id are left out."""
    entries = F.array(*[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes])
    return (
        register.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("id"), F.explode(entries).alias("e"))
        .select("id", "e.attribute", "e.value")
    )


def changes(log: DataFrame, register: DataFrame, key: str, attributes: Sequence[str], at: Column) -> DataFrame:
    """Rows to append to the log so that it ends with ``register``, which holds an id once."""
    held = latest_by(log, ["id", "attribute"], ["changed_at"], ["value"]).select(
        "id", "attribute", F.col("value").alias("__value"), F.col("is_present").alias("__present"))
    offered = attribute_rows(register, key, attributes).withColumn("__offered", F.lit(True))
    both = offered.join(held, ["id", "attribute"], "full_outer").withColumn("is_present", F.col("__offered").isNotNull())
    same = (F.col("is_present") == F.coalesce("__present", F.lit(False))) & (
        ~F.col("is_present") | F.col("value").eqNullSafe(F.col("__value")))
    return both.filter(~same).select("id", "attribute", "value", "is_present", at.alias("changed_at"))


def validity(log: DataFrame, key: Sequence[str] = ("id", "attribute")) -> DataFrame:
    """``(*key, value, valid_from, valid_to)``: an interval per value that held, open at its end while it holds.

    Rows that repeat the value before them make no interval of their own; of rows of one time
    the greatest counts. Times without a value, after a removal, have none.
    """
    of_key = Window.partitionBy(*key).orderBy("changed_at")
    state = F.struct("is_present", F.when(F.col("is_present"), F.col("value")).alias("value"))
    stated = latest_by(log, [*key, "changed_at"], ["is_present"], ["value"]).withColumn("__state", state)
    turns = stated.withColumn("__before", F.lag("__state").over(of_key)).filter(
        ~F.col("__state").eqNullSafe(F.col("__before")))
    return (
        turns.withColumn("valid_to", F.lead("changed_at").over(of_key)).filter("is_present")
        .select(*key, "value", F.col("changed_at").alias("valid_from"), "valid_to")
    )


def _holds(at: Column) -> Column:
    return (F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))


def register_at(intervals: DataFrame, at: Column, attributes: Sequence[str]) -> DataFrame:
    """The register as it was at a time: one row per id, one column per attribute."""
    return intervals.filter(_holds(at)).groupBy("id").agg(*[
        F.max(F.when(F.col("attribute") == a, F.col("value"))).alias(a) for a in attributes])


def drift_between(intervals: DataFrame, since: Column, until: Column, key: Sequence[str] = ("id", "attribute")) -> DataFrame:
    """``(*key, change, old_value, new_value)`` of what differs between two times; both come from one pass."""
    def value(at: Column) -> Column:
        return F.max(F.when(_holds(at), F.struct(F.lit(True).alias("held"), F.col("value").alias("value"))))

    ends = intervals.groupBy(*key).agg(value(since).alias("old"), value(until).alias("new"))
    change = (
        F.when(F.col("old").isNull() & F.col("new").isNotNull(), "added")
        .when(F.col("old").isNotNull() & F.col("new").isNull(), "removed")
        .when(~F.col("old.value").eqNullSafe(F.col("new.value")), "changed")
    )
    return ends.select(
        *key, change.alias("change"), F.col("old.value").alias("old_value"), F.col("new.value").alias("new_value")
    ).filter(F.col("change").isNotNull())


def attach_as_of(
    df: DataFrame, intervals: DataFrame, key: Sequence[str], at: str, value: str, attribute: str | None = None
) -> DataFrame:
    """Left join of the value that held at each row's time ``at``; null where none did.

    Intervals of a key do not overlap, so no row is doubled. Where intervals of many
    attributes are given, ``attribute`` picks one.
    """
    if attribute is not None:
        intervals = intervals.filter(F.col("attribute") == attribute)
    names = {k: f"__{k}" for k in key}
    held = intervals.select(*[F.col(k).alias(n) for k, n in names.items()], F.col("value").alias(value),
                            F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))
    on = [df[k] == held[n] for k, n in names.items()]
    on += [held["__from"] <= df[at], held["__to"].isNull() | (df[at] < held["__to"])]
    return df.join(held, on, "left").drop(*names.values(), "__from", "__to")
