import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardbook.llm.hash_index import Settings, directory, exact_copies, keep_first, owners_of


def plain(rows):
    """What equal texts share, per row."""
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    groups = {}
    for (i, _), text in zip(rows, texts):
        groups.setdefault(text, []).append(i)
    out = Counter()
    for (i, _), text in zip(rows, texts):
        keep = min((x for x in groups[text] if x is not None), default=None)
        out[(i, keep, len(groups[text]), i == keep, hashlib.sha256(text.encode()).hexdigest())] += 1
    return out


def found(docs, settings=Settings()):
    return Counter(tuple(r) for r in exact_copies(docs, settings=settings).collect())


@pytest.mark.parametrize("settings", [
    Settings(), Settings(capacity=300), Settings(capacity=300, key_bits=4), Settings(key_bits=1), Settings(capacity=2000, max_depth=3),
], ids=["one bucket", "many buckets", "chains and splits", "one bit", "a shallow directory"])
def test_equals_a_plain_version(spark, odd, settings):
    draw = random.Random(4)
    more = spark.createDataFrame(
        [(100 + i, draw.choice(["a  copy of it", "a\tcopy of it", "another one", f"own text {i}", "long " * 90])) for i in range(300)],
        "doc_id long, text string",
    )
    docs = odd.select("doc_id", "text").unionByName(more).repartition(5)
    assert found(docs, settings) == plain([tuple(r) for r in docs.collect()])


def test_a_third_of_all_rows_are_copies_and_one_id_repeats(spark):
    docs = spark.range(0, 3000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same")).when(F.col("id") % 3 == 1, F.lit("and this")).otherwise(
            F.col("id").cast("string")).alias("text"),
    )
    assert found(docs, Settings(capacity=4000)) == plain([tuple(r) for r in docs.collect()])


def test_directory_splits_only_what_is_overfull(spark):
    weights = {0: 90, 1: 20, 5: 10, 6: 30}
    slots = spark.createDataFrame(list(weights.items()), "slot long, weight long")
    got = {r["slot"]: (r["bucket"], r["local_depth"], r["weight"]) for r in directory(slots, 3, 50).collect()}
    assert got == {
        0: (0, 3, 90), 1: (1, 3, 20), 2: (2, 2, 0), 3: (2, 2, 0), 4: (4, 1, 40), 5: (4, 1, 40), 6: (4, 1, 40), 7: (4, 1, 40),
    }
    owners = {r["slot"]: r["owner"] for r in owners_of(directory(slots, 3, 50), 50).collect()}
    assert owners == {0: 0, 1: 1, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2, 7: 2}


def test_empty_table_and_columns(spark, odd):
    assert exact_copies(odd.limit(0)).count() == 0
    assert keep_first(odd.limit(0)).columns == odd.columns
    kept = keep_first(odd)
    assert kept.columns == odd.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept.collect()]
    ids = [r["doc_id"] for r in kept.collect()]
    assert Counter(i for i, n in Counter(zip(ids, texts)).items() if n > 1) == Counter({(5, "The SAME line here own words only"): 1})
    assert len(set(texts)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in odd.collect()})


def test_no_python_on_the_way(spark, odd):
    plan = keep_first(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
