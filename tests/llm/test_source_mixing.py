import math
import random
from collections import Counter, defaultdict

from wardbook.llm.source_mixing import copies, mix_sources, source_targets


def water(sizes, weights=(5, 2, 1), most=3):
    """Hand out by weight; what exceeds a source's cap is shared again among the others."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    targets, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return targets | share
        for s in over:
            targets[s] = most * sizes[s]
            left -= targets[s]
        open_ -= over
    return targets


def check(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    totals = {s: sum(r.size for r in own) for s, own in by.items()}
    targets = water(totals)
    for source, own in by.items():
        assert all(r.source_size == totals[source] for r in own)
        assert all(math.isclose(r.target, targets[source], rel_tol=1e-9, abs_tol=1e-9) for r in own)
        rate = targets[source] / totals[source] if totals[source] else 0
        for r in own:
            assert r.copies in (0,) if not r.size else math.floor(rate + 1e-9) <= r.copies <= min(3, math.ceil(rate - 1e-9))
        taken = sum(r.size * r.copies for r in own)
        items = Counter((r.id, r.size) for r in own)
        assert abs(taken - targets[source]) <= max(size * n for (_, size), n in items.items()) + 1e-6


def corpus(spark, n=700, seed=1):
    rng = random.Random(seed)
    rows = [(i, f"s{min(rng.randint(0, 9), 5)}" if i % 50 else None, "w " * rng.choice((0, 1, 5, 60, 900 if i % 90 == 0 else 20))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_each_source_meets_its_target(spark):
    for fan_in in (4, 256):
        rows = copies(corpus(spark), fan_in=fan_in).collect()
        assert len(rows) == 700
        check(rows)


def test_reruns_agree_whatever_the_partitions(spark):
    docs = corpus(spark)
    one, two = (Counter(copies(d, fan_in=16).collect()) for d in (docs, docs.repartition(7)))
    assert one == two


def test_expected_copies_are_the_rate(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * (1 + i % 5)) for i in range(40)], "doc_id long, source string, text string")
    totals = Counter()
    for seed in range(12):
        for r in copies(docs, fan_in=8, seed=seed).collect():
            totals[r.id] += r.copies
            rate = {r.source: r.target / r.source_size}
            assert 0 <= r.copies <= 3 and rate
    means = [totals[i] / 12 for i in range(0, 40, 2)]
    assert 1.15 < sum(means) / len(means) < 1.75 and min(means) > 0.9


def test_caps_are_filled_in_order(spark):
    sizes = {"a": 1, "b": 1000, "c": 0, "d": 3, "e": 10, None: 50}
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long"), (5, 2, 1), 3).collect()
    want = water(sizes)
    assert {r.source: round(r.target, 9) for r in got} == {s: round(t, 9) for s, t in want.items()}


def test_many_small_sources(spark):
    rows = [(i, f"s{i % 211:03d}", "w " * (1 + i % 7)) for i in range(1500)]
    check(copies(spark.createDataFrame(rows, "doc_id long, source string, text string"), fan_in=4).collect())


def test_odd_rows(spark, odd):
    rows = copies(odd).collect()
    assert len(rows) == odd.count()
    check(rows)
    mixed = mix_sources(odd)
    assert mixed.columns == odd.columns
    taken = Counter()
    for r in rows:
        taken[r.id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +taken
    assert copies(odd.limit(0)).count() == 0 and mix_sources(odd.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert [(r.target, r.copies) for r in copies(empty).collect()] == [(0, 0), (0, 0)]
