from collections import Counter

import pytest

from wardbook.llm.sharding import assign_shards, is_prime, key_hash, lookup_table, moved_slots


def plain_table(hashes, shards, size):
    """Turn by turn, each shard walks its own order to the first free slot."""
    table, order, at = [None] * size, {}, Counter()
    for s in shards:
        offset, inverse = hashes[f"offset/{s}"] % size, 1 + hashes[f"step/{s}"] % (size - 1)
        order[s] = sorted(range(size), key=lambda slot: (slot - offset) * inverse % size)
    for turn in range(size):
        shard = shards[turn % len(shards)]
        while table[order[shard][at[shard]]] is not None:
            at[shard] += 1
        table[order[shard][at[shard]]] = shard
    return table


def test_table_is_filled_in_turns(spark):
    shards, size = ["a", "b", "c"], 101
    names = [f"{k}/{s}" for s in shards for k in ("offset", "step")]
    keyed = spark.createDataFrame([(n,) for n in names], "n string")
    hashes = {r[0]: r[1] for r in keyed.select("n", key_hash(keyed.n)).collect()}
    table = {r["slot"]: r["shard"] for r in lookup_table(spark, shards, size).collect()}
    assert [table[i] for i in range(size)] == plain_table(hashes, shards, size)
    counts = Counter(table.values())
    assert max(counts.values()) - min(counts.values()) <= 1


def test_a_lost_shard_moves_few_other_slots(spark):
    before = lookup_table(spark, [f"s{i}" for i in range(8)], 499)
    after = lookup_table(spark, [f"s{i}" for i in range(7)], 499)
    moved = moved_slots(before, after).collect()
    own = sum(r["shard"] == "s7" for r in moved)
    assert own >= 62 and len(moved) - own < 499 * 0.25


def test_odd_rows(spark, odd):
    placed = assign_shards(odd, "doc_id", ["a", "b"], 101)
    rows = placed.collect()
    assert len(rows) == odd.count() and placed.columns == [*odd.columns, "slot", "shard"]
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert assign_shards(odd.limit(0), "doc_id", ["a"], 11).count() == 0
    clash = spark.createDataFrame([(1, 2, "x")], "doc_id long, slot long, shard string")
    assert assign_shards(clash, "doc_id", ["a"], 11).columns == ["doc_id", "slot", "shard"]


@pytest.mark.parametrize("shards,size", [([], 11), (["a", "a"], 11), (["a"], 12), (["a"], 100_003)])
def test_bad_arguments(spark, shards, size):
    with pytest.raises(ValueError):
        lookup_table(spark, shards, size)


def test_primes():
    assert [n for n in range(20) if is_prime(n)] == [2, 3, 5, 7, 11, 13, 17, 19]
