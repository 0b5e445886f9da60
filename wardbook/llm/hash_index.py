"""Exact dedup by an extendible-hash index on shared files.

Texts are compared after each run of white space has become one space. A text's key is a hash of
it, and the leading bits of the key name a slot of the directory. The directory starts as one
bucket; as long as a bucket's texts weigh more than a bucket may hold, the directory doubles and
the bucket is split by its next bit. Neighbouring small buckets share an owner, so an owner has a
range of keys and about one bucket's weight. Each row goes to its owner, the only time texts
move. The owner sorts its range by key and text: what agrees in key but not in bytes is a chain,
and rows that agree in bytes are one entry of it. Owners write their part of the index, which
rows find their entry in.

Copies of one text cannot be split by any hash. Texts whose copies outweigh a bucket are known
from counts by key, and their rows go to all owners in equal parts. Every owner folds its part to one
entry, and entries, which are few, are folded again by their bytes.

The directory has at most ``2 ** max_depth`` slots at any input size, and there are at most
``2 ** max_depth`` such heavy keys; these two tables are what is broadcast.

Defined results: null counts as an empty text. A row without id comes after all others; a group of
such rows alone has a null ``keep_id`` and all of it stays. Rows that repeat id and text are one
document and stay or go together, each counted in ``group_size``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.common import SPACE_RUN, unused_name, workspace


@dataclass(frozen=True)
class Settings:
    """``capacity`` is what a bucket may hold, in bytes of text; it grows where the directory would not."""

    capacity: int = 1 << 24
    max_depth: int = 17
    key_bits: int = 64
    #: Bytes a row weighs beside its text.
    row_bytes: int = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def key_of(text: Column, bits: int) -> Column:
    """The ``bits`` leading bits of a hash, as a number that is not negative below 64 bits."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits)


def _slot(bits: int, depth: int) -> Column:
    return F.shiftrightunsigned("key", bits - depth) if depth else F.lit(0).cast("long")


def directory(slots: DataFrame, depth: int, capacity: int) -> DataFrame:
    """``(slot, bucket, local_depth, weight)`` from ``(slot, weight)``, every slot of the depth included.

    A bucket is named by its first slot. Its local depth is that of the first doubling after
    which it holds no more than ``capacity``, or ``depth``, beyond which nothing is split.
    """
    spark = slots.sparkSession
    every = spark.range(1 << depth).withColumnRenamed("id", "slot").join(slots, "slot", "left").na.fill(0, ["weight"])
    doublings = every.select(
        "slot", "weight", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("local_depth")
    ).withColumn("prefix", F.expr(f"shiftright(slot, {depth} - local_depth)"))
    sizes = doublings.groupBy("local_depth", "prefix").agg(F.sum("weight").alias("held"))
    fits = sizes.filter((F.col("held") <= capacity) | (F.col("local_depth") == depth))
    return (
        doublings.select("slot", "local_depth", "prefix").join(fits, ["local_depth", "prefix"])
        .groupBy("slot").agg(F.min(F.struct("local_depth", "prefix", "held")).alias("b"))
        .select(
            "slot", F.expr(f"shiftleft(b.prefix, {depth} - b.local_depth)").alias("bucket"),
            F.col("b.local_depth").alias("local_depth"), F.col("b.held").alias("weight"),
        )
    )


def owners_of(buckets: DataFrame, capacity: int) -> DataFrame:
    """``(slot, owner)``: consecutive buckets share an owner up to about one capacity."""
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    once = buckets.select("bucket", "weight").distinct()
    dealt = once.withColumn("at", F.sum("weight").over(before) - F.col("weight")).select(
        "bucket", F.floor(F.col("at") / capacity).alias("turn")
    )
    numbered = dealt.withColumn("owner", (F.dense_rank().over(Window.orderBy("turn")) - 1).cast("int"))
    return buckets.select("slot", "bucket").join(numbered.select("bucket", "owner"), "bucket").select("slot", "owner")


def exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``docs``: ``(id, keep_id, group_size, kept, text_sha256)``."""
    work, bits = workspace(docs.sparkSession), settings.key_bits
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text")).withColumn(
        "key", key_of(F.col("text"), bits)
    )
    counted = rows.select("key", (F.octet_length("text") + settings.row_bytes).cast("long").alias("bytes"))
    keys = work.keep(counted.groupBy("key").agg(F.sum("bytes").alias("bytes")), "keys")
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(settings.capacity, total >> (settings.max_depth - 1))
    depth = min(settings.max_depth, bits, max(0, (total // capacity).bit_length() + 3))

    heavy = F.col("bytes") > capacity  # fewer than total / capacity keys
    slots = keys.filter(~heavy).select(_slot(bits, depth).alias("slot"), "bytes").groupBy("slot").agg(
        F.sum("bytes").alias("weight")
    )
    owners = work.keep(owners_of(directory(slots, depth, capacity), capacity).coalesce(1), "directory")
    n_owners = owners.agg(F.max("owner")).first()[0] + 1
    heavy_keys = keys.filter(heavy)
    spread = heavy_keys.agg(F.ceil(F.sum("bytes") / capacity)).first()[0] or 0
    n_owners = max(n_owners, int(spread))

    # The task's number keeps rows that repeat one id from following it to one owner.
    any_owner = F.pmod(F.xxhash64("id", F.spark_partition_id()), F.lit(n_owners)).cast("int")
    dealt = (
        rows.withColumn("slot", _slot(bits, depth)).join(F.broadcast(owners), "slot")
        .join(F.broadcast(heavy_keys.select("key", F.lit(True).alias("heavy"))), "key", "left")
        .select(
            F.when(F.col("heavy"), any_owner).otherwise(F.col("owner")).alias("owner"), "key", "text", "id",
            F.coalesce("heavy", F.lit(False)).alias("heavy"),
        )
    )
    entry, chain = Window.partitionBy("owner", "key", "text"), Window.partitionBy("owner", "key").orderBy("text")
    owned = dealt.repartitionById(n_owners, F.col("owner")).select(
        "owner", "key", F.dense_rank().over(chain).alias("chain"), "id", "heavy",
        F.min("id").over(entry).alias("keep_id"), F.count(F.lit(1)).over(entry).alias("group_size"),
        (~F.lag("text").over(chain).eqNullSafe(F.col("text"))).alias("opens"), "text",
    )
    index = work.keep(
        owned.select(
            "owner", "key", "chain", "id", "heavy", "keep_id", "group_size", F.sha2("text", 256).alias("text_sha256"),
            F.when(F.col("heavy") & F.col("opens"), F.col("text")).alias("bytes"),
        ), "index",
    )

    light = index.filter(~F.col("heavy"))
    parts = Window.partitionBy("key", "bytes")
    folded = index.filter(F.col("heavy") & F.col("bytes").isNotNull()).select(
        "owner", "key", "chain", F.min("keep_id").over(parts).alias("keep_id"),
        F.sum("group_size").over(parts).alias("group_size"),
    )
    spread_rows = index.filter("heavy").drop("keep_id", "group_size").join(folded, ["owner", "key", "chain"])
    found = ["id", "keep_id", "group_size", "text_sha256"]
    return light.select(*found).unionByName(spread_rows.select(*found)).select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Of equal texts the row with the least id, with all its columns."""
    key_id, key_text = unused_name(docs.columns, "__id"), unused_name(docs.columns, "__text")
    dropped = exact_copies(docs, id_col, text_col, settings).filter("NOT kept").select(
        F.col("id").alias(key_id), F.col("text_sha256").alias(key_text)
    ).distinct()
    same = (F.col(f"`{id_col}`").eqNullSafe(F.col(key_id))) & (F.sha2(normalised(F.col(f"`{text_col}`")), 256) == F.col(key_text))
    return docs.join(dropped, same, "left_anti")
