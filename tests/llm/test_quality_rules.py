import math
import random

from pyspark.sql import functions as F

from wardbook.llm.divergence_rules import COMMON_WORDS, Limits, assess, js_distance, keep_good


def test_distance_is_the_jensen_shannon_distance(spark):
    def plain(a, b):
        p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
        kl = lambda u, v: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(u, v) if x)
        return math.sqrt(max(0, (kl(p, q) + kl(q, p)) / 2))

    pairs = [([1, 2, 3], [3, 2, 1]), ([1, 0], [0, 5]), ([4, 4], [1, 1]), ([0, 7, 2], [1, 0, 0])]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    for r in df.select("a", "b", js_distance(F.col("a"), F.col("b")).alias("d")).collect():
        assert math.isclose(r.d, plain(r.a, r.b), abs_tol=1e-9)
    assert spark.createDataFrame([([0], [1]), (None, [1])], df.schema).select(js_distance(F.col("a"), F.col("b"))).collect() == [(None,), (None,)]


def texts(rng, n, words):
    return [" ".join(rng.choice(words) for _ in range(rng.randint(150, 400))) for _ in range(n)]


def test_odd_documents_go_and_clean_ones_stay(spark):
    rng = random.Random(1)
    rare = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(3000)]
    clean = texts(rng, 60, list(COMMON_WORDS["en"]) * 40 + rare)
    junk = [" ".join("#%&{}".format(rng.randint(0, 99999)) for _ in range(300)) for _ in range(3)]
    short = ["a short but fair note of some twelve plain words in all here"]
    rows = [(i, t, "en") for i, t in enumerate([*clean, *short, *junk])]
    kept = {r.doc_id for r in keep_good(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == set(range(61))


def test_odd_rows(spark, odd):
    rows = assess(odd).collect()
    assert len(rows) == odd.count()
    by = {r.id: r for r in rows if r.id not in (5, 9, None)}
    assert by[1].base_failed and by[1].m.n_words == 0 and not by[1].kept
    assert by[6].m.n_words == by[6].m.n_repeat_words == 30_000 and by[6].base_failed
    assert by[7].m.word_chars == 5_000 and by[8].kept
    assert keep_good(odd).columns == odd.columns
    assert keep_good(odd.limit(0)).count() == 0


def test_no_reference_no_comparison(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(50)), None), (2, " ".join(f"{i}" for i in range(90)), "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert keep_good(docs, limits=Limits(min_chars_compared=10**6)).count() == 2


def test_texts_are_counted_once(spark):
    docs = spark.createDataFrame([(1, "a b c " * 200, "en"), (1, None, None)], "doc_id long, text string, lang string")
    found = assess(docs, carry=["doc_id"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "LogicalRDD" not in plan
    assert found.schema["doc"].dataType.names == ["doc_id"]
    whole = assess(docs).drop("doc")
    assert sorted(map(repr, found.drop("doc").collect())) == sorted(map(repr, whole.collect()))
