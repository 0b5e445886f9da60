"""How many of the expected items each unit reported in each period."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardbook.functions.columns import ratio


def expected_counts(
    bridge: DataFrame, group: Sequence[str], item: str, count: str = "expected_indicator_count"
) -> DataFrame:
    """Distinct expected items per group."""
    return bridge.groupBy(*group).agg(F.count_distinct(item).alias(count))


def reported_counts(
    df: DataFrame,
    unit: Sequence[str],
    item: str,
    resolved: str | None = None,
    require_value: str | None = None,
    count: str = "reported_indicator_count",
    rows: str | None = None,
) -> DataFrame:
    """Distinct items per unit and period, among rows where ``resolved`` is not null.

    A row without a value counts as reported unless ``require_value`` names the value column.
    Duplicates of an item fold before the shuffle, so a busy unit does not gather in one task.
    ``rows`` names a column for the count of all rows of the unit, from the same pass; units that
    reported nothing then stay, with a null count.
    """
    if rows is not None:
        counted = [F.col(c).isNotNull() for c in (resolved, require_value) if c is not None]
        reported = F.when(reduce(lambda a, b: a & b, counted, F.lit(True)), F.col(item))
        both = df.groupBy(*unit).agg(F.count_distinct(reported).alias(count), F.count(F.lit(1)).alias(rows))
        return both.withColumn(count, F.nullif(count, F.lit(0)))
    for column in (resolved, require_value):
        if column is not None:
            df = df.filter(F.col(column).isNotNull())
    return df.groupBy(*unit).agg(F.count_distinct(item).alias(count))


def completeness(
    reported: DataFrame,
    expected: DataFrame,
    group: Sequence[str],
    reported_count: str = "reported_indicator_count",
    expected_count: str = "expected_indicator_count",
    score: str = "completeness_score",
) -> DataFrame:
    """Reported divided by expected; null where the group expects nothing or is null."""
    return reported.join(expected, list(group), "left").withColumn(
        score, ratio(F.col(reported_count), F.col(expected_count))
    )


def attach(df: DataFrame, scores: DataFrame, unit: Sequence[str]) -> DataFrame:
    """Left join of the scores onto the rows they were computed from; null keys get no score."""
    return df.join(scores, list(unit), "left")


def score_rows(
    df: DataFrame,
    expected: DataFrame,
    group: Sequence[str],
    unit: Sequence[str],
    item: str,
    resolved: str,
    reported_count: str = "reported_indicator_count",
    expected_count: str = "expected_indicator_count",
    score: str = "completeness_score",
) -> DataFrame:
    """``df`` with the scores that ``attach`` would join to it, counted within each unit.

    For rows without duplicates that nobody else needs scores of: they are shuffled by unit
    either way, and this saves a second pass over them.
    """
    items = F.collect_set(F.when(F.col(resolved).isNotNull(), F.col(item))).over(Window.partitionBy(*unit))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in unit])
    counted = df.withColumn(reported_count, F.when(whole, F.nullif(F.size(items), F.lit(0)).cast("long")))
    found = completeness(counted, expected, group, reported_count, expected_count, score)
    return found.withColumn(expected_count, F.when(F.col(reported_count).isNotNull(), F.col(expected_count)))


def mean_score(
    df: DataFrame,
    by: Sequence[str],
    score: str = "completeness_score",
    mean: str = "avg_completeness_score",
    unit: Sequence[str] | None = None,
    weight: str | None = None,
    ordered: bool = True,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """Mean score per group, sorted by it if ``ordered``.

    By default each row weighs the same, so units with many rows weigh more; ``weight`` names
    a column of row counts where rows were counted before. Naming the ``unit`` columns lets
    each unit weigh the same instead. ``counts`` names the reported and the expected count that
    the score is a quotient of: sums are then of whole numbers, divided once per expected count,
    and the mean is the same to the last bit in whatever order rows come.
    """
    carried = [score, *(counts or ())]
    if unit is not None:
        best = F.max(F.struct(*carried)).alias("__best")
        df = df.groupBy(*dict.fromkeys([*by, *unit])).agg(best).select(*by, "__best.*")
    if counts is not None:
        means = _exact_means(df, by, score, mean, weight if unit is None else None, *counts)
    elif weight is None or unit is not None:
        means = df.groupBy(*by).agg(F.avg(score).alias(mean))
    else:
        weights = F.sum(F.when(F.col(score).isNotNull(), F.col(weight)))
        means = df.groupBy(*by).agg((F.sum(F.col(score) * F.col(weight)) / F.nullif(weights, F.lit(0))).alias(mean))
    return means.orderBy(*by) if ordered else means


def _exact_means(
    df: DataFrame, by: Sequence[str], score: str, mean: str, weight: str | None, reported: str, expected: str
) -> DataFrame:
    rows, scored = F.lit(1) if weight is None else F.col(weight), F.col(score).isNotNull()
    sums = df.groupBy(*by, expected).agg(
        F.sum(F.when(scored, F.col(reported) * rows)).alias("__sum"), F.sum(F.when(scored, rows)).alias("__rows"))
    parts = F.collect_list(F.when(F.col("__sum").isNotNull(), F.struct(expected, "__sum")))
    total = F.aggregate(F.sort_array(parts), F.lit(0.0), lambda a, p: a + p["__sum"].cast("double") / p[expected])
    return sums.groupBy(*by).agg((total / F.nullif(F.sum("__rows"), F.lit(0))).alias(mean))
