import random

import numpy as np
import pytest

from wardbook.llm.common import workspace
from wardbook.llm.components import components
from wardbook.llm.hyperplane_dedup import Settings, near_vectors
from wardbook.llm.ngram_tiles import Settings as TileSettings
from wardbook.llm.ngram_tiles import bitmaps, keep_first, link_counts, linked_roots, near_copies, near_pairs
from wardbook.llm.shingles import shingle_sets, word_hashes


def union(nodes, pairs):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[a], least[b])
            changed |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_components_of_random_links(spark):
    rng = random.Random(4)
    pairs = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    pairs += [(1000, i) for i in range(900, 960)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "u long, v long"), workspace(spark), "t").collect()}
    nodes = {n for p in pairs for n in p}
    want = union(nodes, pairs)
    assert {n: got.get(n, n) for n in nodes} == want
    assert components(spark.createDataFrame([], "u long, v long"), workspace(spark), "none").count() == 0


def plain_set(text, width=5):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in (text or "").encode().decode().split(" ") if w]
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def variants(rng, n, words=60, edits=4):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


def test_shingles_equal_sets_of_words():
    texts = ["a b c d e f g", "A B C D E F G", "a b c d", "a b c d e", "", None, "é É x y z é É x y z", "x" * 3000 + " b c d e f"]
    got = shingle_sets(texts, 5)
    assert [len(s) for s in got] == [len(plain_set(t)) for t in texts]
    assert (got[0] == got[1]).all() and got[2][0] != got[3][0]
    starts, hashes = word_hashes(b"ab cd\x0bab")
    assert starts.tolist() == [0, 3, 6] and hashes[0] == hashes[2] != hashes[1]


def test_bitmaps_bound_the_overlap():
    rng = random.Random(2)
    sets = shingle_sets(variants(rng, 12, 80, 12), 5)
    bits = bitmaps(sets)
    for a, x in zip(bits, sets):
        for b, y in zip(bits, sets):
            most = len(x) - int(np.bitwise_count(a & ~b).sum())
            assert most >= len(np.intersect1d(x, y))


def test_tiles_find_all_links_of_a_group():
    rng = random.Random(5)
    texts = [t for _ in range(6) for t in variants(rng, 9, rng.randint(5, 70), 3)]
    sets = shingle_sets(texts, 5)
    roots = linked_roots(sets, np.zeros(len(sets)), 80)
    plain = [plain_set(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if 100 * len(plain[i] & plain[j]) >= 80 * len(plain[i] | plain[j])]
    want = union(range(len(texts)), pairs)
    assert len({(int(r), want[i]) for i, r in enumerate(roots)}) == len(set(want.values())) == len(set(roots.tolist()))


def check_copies(docs, settings):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    sets = [(i, plain_set(t)) for i, t in rows if i is not None]
    pairs = [(a, b) for a, x in sets for b, y in sets if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    want = union({i for i, _ in sets}, pairs)
    got = near_copies(docs, settings=settings).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == (None if r.id is None else want[r.id]) for r in got)
    return want


def test_copies_in_few_and_in_many_tiles(spark):
    rng = random.Random(6)
    texts = [t for size in (5, 20, 60, 300) for _ in range(4) for t in variants(rng, 12, size, size // 15)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = check_copies(docs, TileSettings())
    assert check_copies(docs, TileSettings(block_weight=3_000)) == want
    assert {r.doc_id for r in keep_first(docs).collect()} == set(want.values())


@pytest.mark.parametrize("block_weight", [2_000_000, 4_000])
def test_every_link_and_its_count(spark, block_weight):
    draw = random.Random(12)
    base = [[f"w{draw.randrange(900)}" for _ in range(60)] for _ in range(4)]
    texts = []
    for i in range(90):
        words = list(draw.choice(base))
        for _ in range(draw.choice([0, 0, 1, 2, 3])):
            words[draw.randrange(60)] = f"x{draw.randrange(50)}"
        texts.append((i, " ".join(words[: draw.choice([60, 60, 55])])))
    texts += [(100, None), (101, ""), (102, "alone")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    shingles = {i: {tuple((t or "").split()[k : k + 5]) for k in range(max(0, len((t or "").split()) - 4))} for i, t in texts}
    shingles[102] = {("alone",)}

    def linked(a, b):
        return a and b and 100 * len(a & b) >= 80 * len(a | b)

    settings = TileSettings(block_weight=block_weight)
    pairs, classes = near_pairs(docs, settings=settings)
    node = dict(map(tuple, classes.collect()))
    assert node == {i: min(j for j in shingles if shingles[j] == s) for i, s in shingles.items() if s}
    firsts = sorted(set(node.values()))
    want = {(a, b) for a in firsts for b in firsts if a < b and linked(shingles[a], shingles[b])}
    assert sorted(map(tuple, pairs.collect())) == sorted(want) and len(want) > 20
    counts = dict(map(tuple, link_counts(docs, settings=settings).collect()))
    assert counts == {i: sum(bool(linked(shingles[i], shingles[j])) for j in shingles if j != i) for i in node}


def test_odd_texts(spark, odd):
    rows = odd.filter("doc_id NOT IN (4, 5, 10) OR doc_id IS NULL")  # words here are split at spaces only
    want = check_copies(rows, TileSettings())
    assert want[9] == 8
    kept = keep_first(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id IS NULL").count() == 2
    assert near_copies(odd.limit(0)).count() == 0


def check_vectors(spark, rows, settings):
    able = [(i, np.array(v, dtype=float) / max(map(abs, v))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    cos = lambda a, b: len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9
    pairs = {(i, j) for i, a in able for j, b in able if i != j and cos(a, b)}
    want = union({i for i, _ in rows if i is not None}, pairs)
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), settings=settings).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == (sum(i == r.id for i, _ in pairs), None if r.id is None else want[r.id])
        assert r.kept == (r.id is None or r.id == r.component_id)


def test_vectors_in_few_and_in_many_blocks(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=16) * 0.05 * (i % 5)]) for i in range(240)]
    rows += [(500 + i, rows[0][1]) for i in range(30)] + [(900, [2e-200 * x for x in rows[1][1]]), (901, [1e200 * x for x in rows[1][1]])]
    for settings in (Settings(recall=0.99999), Settings(recall=0.99999, block=16)):
        check_vectors(spark, rows, settings)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]),
            (8, [1.0, 0.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [0.95, 0.1])]
    check_vectors(spark, rows, Settings(recall=0.99999))
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
