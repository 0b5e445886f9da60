"""Chunked windows equal plain windows and a brute-force loop, however the chunks fall."""

import random

import pytest
from pyspark.sql import functions as F

from wardbook.operators.trailing import HotKeyRanges, HotKeySplit, over_trailing_rows
from wardbook.operators.trends import rolling_mean


def brute(data, start, end):
    out = {}
    keys = {k for k, *_ in data}
    for key in keys:
        ordered = sorted((at, i, v) for k, at, i, v in data if k == key)
        for n, (_, i, _) in enumerate(ordered):
            window = [v for _, _, v in ordered[max(0, n + start): max(0, n + end + 1)] if v is not None]
            out[i] = (len(window), sum(window) if window else None)
    return out


@pytest.mark.parametrize("size, width", [(1, 1), (3, 2), (7, 5), (20, 1), (1000, 1)])
@pytest.mark.parametrize("start, end", [(-11, 0), (-12, -1), (-2, 0)])
def test_chunks_change_nothing(spark, size, width, start, end):
    rng = random.Random(size * 100 + width)
    # One key holds most rows, one is null, times cluster so that bins differ much in size.
    data, n = [], 0
    for key, count in (("hot", 120), ("cold", 9), (None, 30)):
        for _ in range(count):
            data.append((key, rng.choice([3, rng.randrange(60), rng.randrange(60)]), n, rng.choice([None, n, 2 * n])))
            n += 1
    df = spark.createDataFrame(data, "k string, at int, i int, v int").repartition(3)
    bins = F.expr(f"at div {width}")
    for split in (HotKeySplit(bins, size), HotKeyRanges(bins, size), HotKeyRanges(bins, size, keys_at_most=1)):
        got = over_trailing_rows(df, ["k"], ["at", "i"], start, end, {"n": F.count("v"), "s": F.sum("v")}, split)
        assert got.columns == ["k", "at", "i", "v", "n", "s"]
        collected = got.collect()
        assert len(collected) == len(data)
        assert {r["i"]: (r["n"], r["s"]) for r in collected} == brute(data, start, end)


def test_plain_window_agrees_with_brute_force(spark):
    data = [("a", i % 7, i, i) for i in range(40)]
    df = spark.createDataFrame(data, "k string, at int, i int, v int")
    got = over_trailing_rows(df, ["k"], ["at", "i"], -3, 0, {"n": F.count("v"), "s": F.sum("v")})
    assert {r["i"]: (r["n"], r["s"]) for r in got.collect()} == brute(data, -3, 0)


def test_rows_without_an_order_value_come_first(spark):
    data = [("a", None, 1.0), ("a", 1, 2.0), ("a", 2, 3.0), ("a", None, 4.0)]
    df = spark.createDataFrame(data, "k string, at int, v double")
    for split in (HotKeySplit(F.col("at"), rows_per_chunk=2), HotKeyRanges(F.col("at"), rows_per_range=2)):
        got = over_trailing_rows(df, ["k"], ["at", "v"], -1, 0, {"s": F.sum("v")}, split)
        assert sorted(r["s"] for r in got.collect()) == [1.0, 5.0, 5.0, 6.0]


def test_bins_may_be_structs(spark):
    data = [("a", 1, i, i) for i in range(50)] + [("b", i, 100 + i, i) for i in range(5)]
    df = spark.createDataFrame(data, "k string, at int, i int, v int")
    split = HotKeySplit(F.struct("at", F.expr("i div 4")), rows_per_chunk=10)
    got = over_trailing_rows(df, ["k"], ["at", "i"], -6, 0, {"n": F.count("v"), "s": F.sum("v")}, split)
    assert {r["i"]: (r["n"], r["s"]) for r in got.collect()} == brute(data, -6, 0)


def test_rolling_mean_of_a_split_key(spark):
    totals = spark.range(300).selectExpr("'k' k", "id at", "cast(hash(id) % 100 as double) monthly_value")
    columns = ["at", "rolling_3_month_avg"]
    plain = rolling_mean(totals, ["k"], "at", min_periods=3).select(columns).collect()
    split = rolling_mean(totals, ["k"], "at", min_periods=3, split=HotKeySplit(F.expr("at div 3"), 20))
    assert sorted(split.select(columns).collect(), key=str) == sorted(plain, key=str)


def test_ranges_of_one_key_are_of_like_size_however_its_rows_lie(spark):
    from wardbook.operators.trailing import _ranges_of_hot_keys

    df = spark.range(40_000).selectExpr(
        "'k' k", "case when id % 2 = 0 then id else 39000 + id / 40 end at", "id i")
    ranges = _ranges_of_hot_keys(df, ["k"], HotKeyRanges(F.col("at"), rows_per_range=200))
    sizes = [r["count"] for r in ranges.groupBy("__range").count().collect()]
    assert 150 <= len(sizes) <= 260 and max(sizes) < 1000
