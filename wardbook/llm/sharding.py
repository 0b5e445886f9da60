"""Sharding through a permutation-filled lookup table.

Each shard prefers the slots of a prime-sized table in an order of its own, a permutation given
by an offset and a step that come from its name. Shards take turns; the one whose turn it is
claims its best slot that is still free, until none is. So shards differ by one slot at most,
and a shard that joins or leaves moves few slots beside its own. A row's key hashes to a slot,
and the slot names the shard: one look into a table of ``table_size`` rows, whatever the input.

Defined results: a null key counts as an empty string, so all null keys share a shard; equal
keys always do. With no shard there is no placement, which is an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm.common import unused_name

#: Filling the table takes steps in proportion to its square, on one row, whatever the input has.
MAX_TABLE_SIZE = 16_411


def key_hash(key: Column, salt: str = "") -> Column:
    """60 bits of the MD5 of a key's text as a long: the same in any SQL engine."""
    digits = F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(spark: SparkSession, shards: Sequence[str], table_size: int = 4099) -> DataFrame:
    """``(slot, shard)``, one row per slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards must be named, and named once")
    if not is_prime(table_size) or not len(shards) <= table_size <= MAX_TABLE_SIZE:
        raise ValueError(f"table_size must be a prime, at least the shards and at most {MAX_TABLE_SIZE}")
    size, n = F.lit(table_size), len(shards)
    names = spark.range(1).select(F.array(*[F.lit(s) for s in shards]).alias("shard"))
    # With a prime size each step but 0 visits every slot. A slot's rank in a shard's order is
    # (slot - offset) * step^-1, and step^-1 is a step like any other: so it is drawn itself.
    prefer = names.select(
        "shard",
        F.transform("shard", lambda s: key_hash(s, "offset/") % size).alias("offset"),
        F.transform("shard", lambda s: 1 + key_hash(s, "step/") % (size - 1)).alias("inverse"),
    )

    def claim(state: Column, turn: Column) -> Column:
        who = (turn % n).cast("int")
        offset, inverse = F.get(state["offset"], who), F.get(state["inverse"], who)
        # One number per free slot, its rank before the slot itself.
        best = F.array_min(F.transform(
            state["free"], lambda slot: (slot + size - offset) * inverse % size * size + slot
        )) % size
        return F.struct(
            F.array_remove(state["free"], best).alias("free"),
            F.concat(state["claimed"], F.array(best)).alias("claimed"),
            state["offset"].alias("offset"), state["inverse"].alias("inverse"),
        )

    slots = F.sequence(F.lit(0).cast("long"), size.cast("long") - 1)
    start = F.struct(
        slots.alias("free"), F.array().cast("array<bigint>").alias("claimed"), "offset", "inverse",
    )
    filled = prefer.select("shard", F.aggregate(slots, start, claim, lambda s: s["claimed"]).alias("claimed"))
    return filled.select("shard", F.posexplode("claimed").alias("turn", "slot")).select(
        "slot", F.get("shard", F.col("turn") % n).alias("shard")
    )


def assign_shards(
    df: DataFrame, key: str, shards: Sequence[str], table_size: int = 4099, shard_col: str = "shard"
) -> DataFrame:
    """``df`` with the shard of each row in ``shard_col``, and its slot in ``slot``.

    The table has ``table_size`` rows, at most ``MAX_TABLE_SIZE``: that bounds the broadcast.
    Columns of the two names are replaced.
    """
    slot, shard = unused_name(df.columns, "__slot"), unused_name(df.columns, "__shard")
    table = lookup_table(df.sparkSession, shards, table_size).toDF(slot, shard)
    kept = df.drop("slot", shard_col)
    return (
        kept.withColumn(slot, key_hash(F.col(f"`{key}`")) % table_size)
        .join(F.broadcast(table), slot)
        .select(*[F.col(f"`{c}`") for c in kept.columns], F.col(slot).alias("slot"), F.col(shard).alias(shard_col))
    )


def moved_slots(before: DataFrame, after: DataFrame) -> DataFrame:
    """Slots whose shard differs between two tables of one size: ``(slot, shard, new_shard)``."""
    return before.join(after.withColumnRenamed("shard", "new_shard"), "slot").filter("shard <> new_shard")
