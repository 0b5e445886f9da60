"""Aggregates over the preceding rows of each key, also where one key is too big for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.functions.columns import join_null_safe


@dataclass(frozen=True)
class HotKeySplit:
    """How to cut big keys into chunks.

    ``bin`` is an expression that never falls as the window order rises, such as the minute
    of the ordering timestamp. Rows of one bin stay together; a chunk is a run of bins with
    about ``rows_per_chunk`` rows. Bins should be fine enough to fit a task, coarse enough
    that bins per key stay far below rows per key. Where one value of the first order column
    is itself too frequent, a struct that goes on with the next column makes finer bins.
    """

    bin: Column
    rows_per_chunk: int = 1_000_000


@dataclass(frozen=True)
class HotKeyRanges:
    """How to cut big keys into ranges of their order, and shuffle every row once.

    ``position`` is a number that never falls as the window order rises, such as the seconds of the
    ordering timestamp; rows that share one stay together. Keys of more than ``rows_per_range``
    rows are cut, of these the ``keys_at_most`` biggest, so that the table of borders has a
    bounded size; a key beyond has less than that part of all rows.
    """

    position: Column
    rows_per_range: int = 1_000_000
    keys_at_most: int = 10_000


#: Quantiles of a hot key's positions; what lies between two of them is cut evenly if still too big.
QUANTILES = 64


def over_trailing_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    start: int,
    end: int,
    measures: Mapping[str, Column],
    split: HotKeySplit | HotKeyRanges | None = None,
) -> DataFrame:
    """Add each aggregate in ``measures`` over rows ``start`` to ``end`` relative to the row.

    Both offsets are zero or negative. Order is ascending, nulls first, and should be total
    for repeatable results. Without ``split`` a key is one window partition, right where rows
    per key are bounded (one per month, say). With it a key is cut into chunks that are
    computed side by side; each chunk also receives the ``-start`` rows before it, so the
    result is the same to the last row. ``HotKeyRanges`` finds these rows after the shuffle, at the
    end of each range, instead of sending bins to all chunks they lead into.
    """
    if split is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(start, end)
        return df.withColumns({name: agg.over(window) for name, agg in measures.items()})
    if isinstance(split, HotKeyRanges):
        return _over_ranges(df, keys, order, start, end, measures, split)

    columns = df.columns
    binned = df.withColumn("__bin", split.bin)
    chunks = _chunks_per_bin(binned, keys, split.rows_per_chunk, carry=-start)
    placed = (
        join_null_safe(binned, chunks, [*keys, "__bin"])
        .select(*columns, F.explode("__chunks").alias("__place"))
        .select(
            *columns,
            F.col("__place.chunk").alias("__chunk"),
            F.col("__place.lead_in").alias("__lead_in"),
        )
    )
    window = Window.partitionBy(*keys, "__chunk").orderBy(*order).rowsBetween(start, end)
    return (
        placed.withColumns({name: agg.over(window) for name, agg in measures.items()})
        .filter(~F.col("__lead_in"))
        .drop("__chunk", "__lead_in")
    )


def _chunks_per_bin(binned: DataFrame, keys: Sequence[str], size: int, carry: int) -> DataFrame:
    """For each key and bin: the chunk it belongs to and the later chunks it leads into.

    With ``first`` and ``after`` the positions of a bin's first row and of the row after its
    last, the bin belongs to chunk ``first div size``. A later chunk starts at the first row
    of some bin, at position p >= after, and needs this bin if p < after + carry. Such a
    chunk's number ``p div size`` lies between ``after div size`` and
    ``(after + carry - 1) div size``, so the bin goes to all of these. Bins in between qualify
    as well, hence the rows leading into a chunk have no gap. Only counts are shuffled here.
    """
    running = Window.partitionBy(*keys).orderBy(F.col("__bin").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        binned.groupBy(*keys, "__bin")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .withColumn("__after", F.sum("__rows").over(running))
        .withColumn("__own", F.expr(f"(__after - __rows) div {size}"))
        .withColumn("__from", F.expr(f"greatest(__own + 1, __after div {size})"))
        .withColumn("__to", F.expr(f"(__after + {carry} - 1) div {size}"))
        .select(
            *keys,
            "__bin",
            F.expr(
                "concat(array(named_struct('chunk', __own, 'lead_in', false)),"
                " if(__to >= __from,"
                " transform(sequence(__from, __to), c -> named_struct('chunk', c, 'lead_in', true)),"
                " array()))"
            ).alias("__chunks"),
        )
    )


def _ranges_of_hot_keys(df: DataFrame, keys: Sequence[str], split: HotKeyRanges) -> DataFrame:
    """``df`` with ``__range``: a number that rises with the position, null for keys that are not cut.

    One pass over keys and positions finds the quantiles, as a range partitioning would by a sample.
    """
    at = df.withColumn("__at", split.position.cast("double"))
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    hot = (
        at.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx("__at", shares, 1000).alias("__borders"))
        .filter(F.col("__n") > split.rows_per_range).orderBy(F.desc("__n")).limit(split.keys_at_most)
    )
    joined = join_null_safe(at, F.broadcast(hot), keys, "left")
    position, ranges = F.col("__at"), F.ceil(F.col("__n") / split.rows_per_range)
    quantile = reduce(
        lambda a, b: a + b, [(position >= F.get("__borders", F.lit(i))).cast("int") for i in range(1, QUANTILES)])
    low, high = F.get("__borders", F.col("__q")), F.get("__borders", F.col("__q") + 1)
    # Few ranges take several quantiles each; many cut each quantile into even steps.
    together = F.floor(F.col("__q") * F.least(ranges, F.lit(QUANTILES)) / QUANTILES)
    steps = F.ceil(ranges / QUANTILES)
    step = F.when((steps > 1) & (high > low), F.floor((position - low) / (high - low) * steps)).otherwise(0)
    within = F.greatest(F.lit(0), F.least(step, steps - 1))
    number = together * F.lit(1 << 31) + within
    return joined.withColumn("__q", quantile).withColumn(
        "__range", F.when(F.col("__n").isNotNull(), F.coalesce(number.cast("long"), F.lit(-1)))
    ).select(*df.columns, "__range")


def _over_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], start: int, end: int, measures: Mapping[str, Column],
    split: HotKeyRanges,
) -> DataFrame:
    columns, of_range = df.columns, [*keys, "__range"]
    rows = _ranges_of_hot_keys(df, keys, split).repartition(*of_range)
    from_end = Window.partitionBy(*of_range).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    tails = (
        rows.filter(F.col("__range").isNotNull()).withColumn("__from_end", F.row_number().over(from_end))
        .filter(F.col("__from_end") <= -start)
        .groupBy(*of_range).agg(F.collect_list(F.struct(*[F.col(c) for c in columns])).alias("__tail"))
    )
    # A range of fewer rows than the window looks back on hands on those of the ranges before it.
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(start, -1)
    lead_in = (
        tails.withColumn("__rows", F.flatten(F.collect_list("__tail").over(before)))
        .select(F.col("__range"), F.explode("__rows").alias("__row")).select("__row.*", "__range")
        .repartition(*of_range)
    )
    # Both sides are dealt alike, so the union needs no further shuffle.
    both = rows.withColumn("__lead_in", F.lit(False)).unionByName(lead_in.withColumn("__lead_in", F.lit(True)))
    window = Window.partitionBy(*of_range).orderBy(*order).rowsBetween(start, end)
    return (
        both.withColumns({name: agg.over(window) for name, agg in measures.items()})
        .filter(~F.col("__lead_in")).drop("__range", "__lead_in")
    )
