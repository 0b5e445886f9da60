import random
import re
from collections import Counter

import numpy as np
import pytest

from wardbook.llm.pointer_audit import LONG_TOKEN, audit, multikey_sort, term_counts, token_pointers

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_counts(rows):
    n, docs = Counter(), Counter()
    for lang, source, text in rows:
        terms = TERM.findall((text or "").translate(LOWER))
        for t in terms:
            n[(lang or "", source or "", t)] += 1
        for t in set(terms):
            docs[(lang or "", source or "", t)] += 1
    return {k: (v, docs[k]) for k, v in n.items()}


def plain_audit(rows, min_docs, top, scale):
    counts = plain_counts(rows)
    out = set()
    for lang in {r[0] or "" for r in rows}:
        sources = {r[1] or "" for r in rows if (r[0] or "") == lang}
        in_docs, in_lang = Counter(), Counter()
        for (of, _, t), (n, d) in counts.items():
            if of == lang:
                in_docs[t] += d
                in_lang[t] += n
        terms = [t for t, d in in_docs.items() if d >= min_docs]
        v = len(terms)

        def rates(n_of):
            total = sum(n_of(t) for t in terms)
            return {t: 1 + scale * (n_of(t) + 1) // (total + v) for t in terms}

        n_of = {s: (lambda t, s=s: counts.get((lang, s, t), (0, 0))[0]) for s in sources}
        p, q = {s: rates(n_of[s]) for s in sources}, rates(lambda t: in_lang[t])
        for s in sources:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in terms), o) for o in sources - {s}]
            lead = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in terms if n_of[s](t) and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", lead)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                for k, (value, item) in enumerate(ranked if part == "pair" else ranked[:top], 1):
                    out.add((lang, s, part, item, value, k))
    return out


@pytest.fixture()
def corpus(spark, odd):
    draw = random.Random(9)
    words = ["the", "The", "of", "Straße", "été", "zoo", "ab", "abc", "a" * 8, "a" * 9, "b" * 300, "b" * 301, "naïve", "x1y"]
    rows = [
        (draw.choice(["en", "de", None]), draw.choice(["s0", "s0", "s1", "s2", None]), " ".join(draw.choices(words, k=draw.randint(0, 30))))
        for _ in range(120)
    ] + [("lone", "s9", "only one"), ("none", "a", None), ("none", "b", "12 34")]
    more = spark.createDataFrame(rows, "lang string, source string, text string")
    return odd.select("lang", "source", "text").unionByName(more).repartition(5)


@pytest.mark.parametrize("min_docs,top,scale", [(3, 200, 1_000_000_000), (1, 2, 1000), (1000, 5, 1000)])
def test_equals_a_plain_version(corpus, min_docs, top, scale):
    got = [tuple(r) for r in audit(corpus, min_docs=min_docs, top=top, scale=scale).collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_audit([tuple(r) for r in corpus.collect()], min_docs, top, scale)


def test_counts(corpus):
    got = {tuple(r)[:3]: tuple(r)[3:] for r in term_counts(corpus).collect()}
    assert got == plain_counts([tuple(r) for r in corpus.collect()])


def test_multikey_sort_orders_by_bytes():
    draw = random.Random(2)
    tokens = ["".join(draw.choices("ab", k=draw.randint(1, 20))) for _ in range(500)]
    tokens += ["a" * (LONG_TOKEN + k % 3) + "b" for k in range(9)] + ["é" * LONG_TOKEN] * 3
    raw = np.frombuffer(" ".join(tokens).encode(), dtype=np.uint8)
    starts, ends = token_pointers(raw)
    order, first = multikey_sort(raw, starts, ends)
    assert len(starts) == len(tokens)
    want = sorted(range(len(tokens)), key=lambda i: (tokens[i].encode(), i))
    assert order.tolist() == want
    assert first.tolist() == [i == 0 or tokens[want[i]] != tokens[want[i - 1]] for i in range(len(want))]


def test_empty_table_and_odd_columns(odd):
    assert audit(odd.limit(0)).count() == 0
    assert audit(odd).columns == ["lang", "source", "part", "item", "value", "rank"]
