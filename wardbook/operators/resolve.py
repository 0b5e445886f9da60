"""Resolving keys against lookups, and finding the rows that do not resolve.

No broadcast of a lookup is forced. Spark broadcasts one that is below the session's threshold by the
size of its files, and otherwise shuffles both sides. Rows without a key can match nothing, so
they are dealt by other columns instead of meeting in one task; keys that very many rows share are dealt to
several tasks where the caller asks for it, and else left to Spark's splitting of skewed joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HeavyKeys:
    """Deal keys of more than ``rows_per_task`` rows to several tasks, the lookup's row to each.

    Of these, the ``at_most`` heaviest, so that the table of their weights has a bounded size; a
    key beyond has less than that part of all rows. Counting them is one pass over the keys.
    """

    rows_per_task: int = 5_000_000
    at_most: int = 10_000


def _spread(keys: Sequence[str], by: Sequence[str]) -> Column:
    """A number of its own for each row without a key, zero for all others."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.xxhash64(*[F.col(c) for c in by])).otherwise(F.lit(0).cast("long"))


def resolve(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], spread: Sequence[str] = (), heavy: HeavyKeys | None = None
) -> DataFrame:
    """Left join: every row stays, lookup columns are null where a key is unknown or null.

    ``spread`` names columns that tell rows without a key apart; with it a shuffled join deals
    them evenly. ``heavy`` also needs it, to tell the rows of one key apart.
    """
    keys = list(keys)
    if not spread:
        return df.join(lookup, keys, "left")
    on = [*keys, "__spread"]
    if heavy is None:
        # Zero, but no literal: that would leave the join's keys and with it the shuffle.
        found = lookup.withColumn("__spread", F.pmod(F.xxhash64(*keys), F.lit(1)))
        return df.withColumn("__spread", _spread(keys, spread)).join(found, on, "left").drop("__spread")
    weights = (
        df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
        .filter(F.col("__rows") > heavy.rows_per_task).orderBy(F.desc("__rows"), *keys).limit(heavy.at_most)
        .select(*keys, F.ceil(F.col("__rows") / heavy.rows_per_task).alias("__tasks"))
    )
    of_row = F.when(F.col("__tasks").isNotNull(), F.pmod(F.xxhash64(*spread), F.col("__tasks"))).otherwise(_spread(keys, spread))
    dealt = df.join(F.broadcast(weights), keys, "left").withColumn("__spread", of_row).drop("__tasks")
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("__tasks", F.lit(1)) - 1)
    found = lookup.join(F.broadcast(weights), keys, "left").withColumn("__spread", F.explode(copies)).drop("__tasks")
    return dealt.join(found, on, "left").drop("__spread")


def unresolved(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is unknown to the lookup; a null key is unknown."""
    return df.join(lookup.select(*keys), list(keys), "left_anti")


def flag_unresolved(
    df: DataFrame, lookups: Mapping[str, tuple[DataFrame, Sequence[str]]], spread: Sequence[str] = ()
) -> DataFrame:
    """Add a flag per lookup, true where ``unresolved`` would list the row, in one pass over ``df``.

    ``lookups`` maps the flag to a lookup, which holds each key once, and its key columns;
    ``spread`` is that of ``resolve``.
    """
    for flag, (lookup, keys) in lookups.items():
        found = lookup.select(*keys, F.lit(True).alias(flag))
        df = resolve(df, found, keys, spread).withColumn(flag, F.col(flag).isNull())
    return df
