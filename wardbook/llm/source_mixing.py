"""Mixing sources to target weights by pivotal dependent rounding.

A source with twice the words it should give takes each document with probability one half; one
with too few takes some documents twice. So each document starts with ``target / source size``
copies, of which only the fraction is open. Two open documents of a source meet: words pass from
one to the other, in a random direction, until one fraction is 0 or 1. That keeps the expected
copies of both and, exactly, the expected words of the source. The one still open meets the
next. A tree does it: documents fall into chunks of about ``fan_in``, each chunk folds down to
one open document, the open ones of a source fall into chunks again, and the last one of a
source is rounded by itself. So a source's words miss its target by less than one document, and
no task holds more than a chunk.

Defined results: a null text has no words; documents without words are never taken, and rows
without a source form a source of their own, the last. Rows that agree in id, source and size are
one item: they get the same number of copies. Draws come from hashes of ids, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.common import unused_name, word_count, workspace


def sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )


def source_targets(sizes: DataFrame, weights: Sequence[float], max_copies: int) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources in order take the weights in turn. Filling them at one level, ``level * weight``
    words each but at most ``max_copies`` times their size, shares all words: sources are put in
    the order in which they overflow, and the level is that of the first that does not. The
    windows run over one row per source.
    """
    turn, of_all = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    fills = Window.orderBy("fills_at", "turn")
    before = fills.rowsBetween(Window.unboundedPreceding, -1)
    onward = fills.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") - 1) % len(weights) + 1)
    levels = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("turn", F.row_number().over(turn))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(max_copies)))
        .withColumn("fills_at", F.col("cap") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(of_all).cast("double"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
        .withColumn("open", F.col("level") < F.col("fills_at"))
        .withColumn("at", F.min(F.when(F.col("open"), F.struct("fills_at", "turn", "level"))).over(of_all)["level"])
    )
    target = F.least(F.col("cap"), F.coalesce(F.col("at"), F.lit(float("inf"))) * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def draw(seed: int, *parts: Column) -> Column:
    """Uniform on [0, 1), the same for the same parts."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 11)
    return bits.cast("double") / F.lit(float(2**53))


def _meet(open_: Column, other: Column, seed: int) -> tuple[Column, Column]:
    """Both after mass has passed between them, as structs ``(id, size, rest, up)``.

    ``rest`` is the fraction still open, null once the item is decided by ``up``.
    """
    mine, theirs = open_["rest"] * open_["size"], other["rest"] * other["size"]
    give = F.least(mine, other["size"] - theirs)
    take = F.least(open_["size"] - mine, theirs)
    gives = draw(seed, open_["id"], open_["size"], other["id"], other["size"]) * (give + take) < take

    def settled(item: Column, words: Column, at_bottom: Column, at_top: Column) -> Column:
        return F.struct(
            item["id"].alias("id"), item["size"].alias("size"),
            F.when(~at_bottom & ~at_top, words / item["size"]).alias("rest"),
            F.when(at_bottom, False).when(at_top, True).alias("up"),
        )

    moved = F.when(gives, -give).otherwise(take)
    # Which bound is met is known from the amount passed, so that no rounding hides it.
    mine_empty, theirs_full = gives & (give >= mine), gives & (give >= other["size"] - theirs)
    mine_full, theirs_empty = ~gives & (take >= open_["size"] - mine), ~gives & (take >= theirs)
    return (
        settled(open_, mine + moved, mine_empty, mine_full),
        settled(other, theirs - moved, theirs_empty, theirs_full),
    )


ITEM = "struct<id:bigint,size:double,rest:double,up:boolean>"


def fold_chunks(items: DataFrame, seed: int) -> DataFrame:
    """One row per ``(source, chunk)``: ``decided`` items, and the ``open`` one or null."""

    def step(state: Column, item: Column) -> Column:
        mine, theirs = _meet(state["open"], item, seed)
        met = F.struct(mine.alias("mine"), theirs.alias("theirs"))
        # At least one of both is decided; if both are, the next item starts anew.
        after = F.transform(F.array(met), lambda m: F.struct(
            F.when(m["mine"]["up"].isNull(), m["mine"]).when(m["theirs"]["up"].isNull(), m["theirs"]).alias("open"),
            F.filter(F.array(m["mine"], m["theirs"]), lambda x: x["up"].isNotNull()).alias("new"),
        ))
        fresh = F.struct(item.alias("open"), F.array().cast(f"array<{ITEM}>").alias("new"))
        took = F.when(state["open"].isNull(), fresh).otherwise(F.get(after, 0))
        return F.transform(F.array(took), lambda t: F.struct(
            t["open"].alias("open"), F.concat(state["decided"], t["new"]).alias("decided"),
        ))[0]

    start = F.struct(F.lit(None).cast(ITEM).alias("open"), F.array().cast(f"array<{ITEM}>").alias("decided"))
    gathered = items.groupBy("source", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("order", F.struct("id", "size", "rest", "up").alias("item")))).alias("in")
    )
    folded = gathered.withColumn(
        "out", F.aggregate(F.transform("in", lambda x: x["item"]), start, step)
    )
    return folded.select("source", F.col("out.open").alias("open"), F.col("out.decided").alias("decided"))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[float] = (5, 2, 1),
    max_copies: int = 3,
    fan_in: int = 256,
    seed: int = 20,
) -> DataFrame:
    """One row per row of ``docs``: ``(id, source, size, source_size, target, copies)``."""
    work = workspace(docs.sparkSession)
    sizes = work.keep(sized(docs, id_col, source_col, text_col), "sizes")
    targets = work.keep(source_targets(sizes, weights, max_copies), "targets")
    wanted = sizes.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left"
    ).drop("of").withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ).withColumn("whole", F.floor("rate"))
    open_items = (
        wanted.filter("size > 0 AND rate > whole")
        .groupBy("id", "source", "size", "rate", "whole").agg(F.count("*").alias("rows"))
        .select(
            "source", "id", "size", (F.col("size") * F.col("rows")).cast("double").alias("mass"),
            (F.col("rate") - F.col("whole")).alias("rest"),
        )
    )
    # An item is its id and its size within a source; the size in words comes back in the end.
    items = work.keep(open_items, "items")
    level = items.select(
        "source", "id", F.col("mass").alias("size"), "rest", F.lit(None).cast("boolean").alias("up"),
        F.xxhash64(F.lit(seed), "id", "size").alias("order"),
    )
    decided, depth = [], 0
    while True:
        # Each source has chunks by its own number of items, and each level fewer by ``fan_in``.
        chunks = work.keep(level.groupBy(F.col("source").alias("of")).agg(
            F.ceil(F.count("*") / fan_in).alias("chunks")
        ), f"chunks-{depth}")
        # The hash that spreads differs by level, so that each chunk gathers anew.
        chunk = F.pmod(F.xxhash64(F.lit(seed + 1 + depth), "order"), F.col("chunks"))
        placed = level.join(chunks, F.col("source").eqNullSafe(F.col("of"))).withColumn("chunk", chunk)
        folded = work.keep(fold_chunks(placed, seed + depth), f"level-{depth}")
        decided.append(folded.select("source", F.explode("decided").alias("item")))
        left = folded.filter(F.col("open").isNotNull())
        if (chunks.agg(F.max("chunks")).first()[0] or 1) == 1:
            break
        level = left.select("source", "open.*").withColumn("order", F.xxhash64(F.lit(seed), "id", "size"))
        depth += 1
    last = F.struct(
        "open.id", "open.size", "open.rest", (draw(seed, F.col("open.id"), F.col("open.size")) < F.col("open.rest")).alias("up")
    )
    decided.append(left.select("source", last.cast(ITEM).alias("item")))
    ups = (
        reduce(DataFrame.unionByName, decided).filter("item.up")
        .select(F.col("source").alias("of"), F.col("item.id").alias("up_id"), F.col("item.size").alias("up_mass"))
    )
    named = items.select(F.col("source").alias("s"), F.col("id").alias("i"), F.col("size").alias("z"), "mass")
    extra = named.join(
        ups, F.col("s").eqNullSafe(F.col("of")) & F.col("i").eqNullSafe(F.col("up_id")) & (F.col("mass") == F.col("up_mass"))
    ).groupBy("s", "i", "z").agg(F.lit(1).alias("extra"))
    joined = wanted.join(
        extra, F.col("source").eqNullSafe(F.col("s")) & F.col("id").eqNullSafe(F.col("i")) & (F.col("size") == F.col("z")), "left"
    )
    # Rows without words have nothing to give, at any rate.
    n_copies = F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + F.coalesce("extra", F.lit(0))).cast("int")
    return joined.select("id", "source", "size", "source_size", "target", n_copies.alias("copies"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns as before."""
    size, i, s, z, n = (unused_name(docs.columns, f"__{x}") for x in ("size", "id", "source", "words", "copies"))
    taken = (
        copies(docs, id_col, source_col, text_col, **options).filter("copies > 0")
        .groupBy(F.col("id").alias(i), F.col("source").alias(s), F.col("size").alias(z))
        .agg(F.max("copies").alias(n))
    )
    mixed = docs.withColumn(size, word_count(F.col(text_col))).join(
        taken, F.col(id_col).eqNullSafe(F.col(i)) & F.col(source_col).eqNullSafe(F.col(s)) & (F.col(size) == F.col(z))
    )
    return mixed.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*[F.col(f"`{c}`") for c in docs.columns])
