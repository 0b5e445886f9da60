import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from wardbook.llm.importance_resampling import Settings, features, resample

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, settings):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, settings.max_n + 1) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % settings.buckets for r in runs]


def plain(rows, target, settings):
    docs = [(i, *plain_features(text, settings)) for i, text in rows]
    s, t = Counter(b for _, _, f in docs for b in f), Counter(b for x in target for b in plain_features(x, settings)[1])
    n_s, n_t, size = sum(s.values()), sum(t.values()), settings.buckets
    gain = lambda b: math.floor(settings.scale * math.log((t[b] + 1) * (n_s + size) / ((s[b] + 1) * (n_t + size))))
    out = []
    for i, words, f in docs:
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{settings.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-settings.scale * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, words, len(f), weight, weight + noise))
    able = sorted(
        (r for r in out if r[1] >= settings.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1:4])
    )
    drawn = able[: len(able) * settings.percent // 100]
    rest = Counter(out) - Counter(drawn)
    return Counter((*r, k) for k, r in enumerate(drawn, 1)) + Counter((*r, None) for r in rest.elements())


@pytest.mark.parametrize("settings", [
    Settings(), Settings(max_n=3, buckets=50, min_words=3, percent=60, seed=7), Settings(min_words=0, percent=100),
], ids=["contract", "runs of three", "all drawn"])
def test_equals_a_plain_version(spark, odd, settings):
    more = spark.createDataFrame(
        [(50 + i % 30, " ".join(f"Wort{(i * k) % 23}" for k in range(i))) for i in range(60)], "doc_id long, text string"
    )
    docs = odd.select("doc_id", "text").unionByName(more).repartition(4)
    target = spark.createDataFrame([("one TWO wort3",), (None,), ("",), ("wort3 wort5-x",)], "text string")
    got = Counter(tuple(r) for r in resample(docs, target, settings=settings).collect())
    assert got == plain([tuple(r) for r in docs.collect()], [r[0] for r in target.collect()], settings)


def test_features_stop_at_the_end_of_a_text():
    texts = ["a b", "", None, "c", "d\x00e f", "g"]
    words, owners, buckets = features(texts, Settings(max_n=2, buckets=1 << 20))
    assert words.tolist() == [2, 0, 0, 1, 3, 1]
    assert Counter(owners.tolist()) == Counter({0: 3, 3: 1, 4: 5, 5: 1})
    assert set(buckets.tolist()) == {b for x in texts for b in plain_features(x, Settings(max_n=2, buckets=1 << 20))[1]}


def test_empty_tables_and_odd_columns(spark, odd):
    none = odd.limit(0)
    assert resample(none, none).count() == 0
    alone = resample(odd, none)
    assert alone.columns == ["id", "n_words", "n_features", "weight", "score", "rank"] and alone.count() == odd.count()
