import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from wardbook.llm import gru
from wardbook.llm.common import workspace
from wardbook.llm.recurrent_lm import (
    END, Settings, Vocabulary, document_scores, schedule, shape_of, split_words, tokens, vocabulary,
)

SMALL = Settings(shortlist=40, classes=5, hidden=6, max_hot=60, buffer_tokens=2_000, count_words=50)


def small_model(seed=0):
    counts = np.array([9, 7, 5, 3, 2, 1])
    shape = gru.Shape(gru.equal_mass_classes(counts, 3), 4)
    flat = gru.initial(shape, counts, 8, seed).astype(np.float64)
    gru.FLOAT, kept = np.float64, gru.FLOAT
    try:
        yield shape, flat
    finally:
        gru.FLOAT = kept


@pytest.fixture()
def model():
    yield from small_model()


def plain_score(shape, flat, words, start):
    """One word at a time, with no windows and no lanes."""
    p, h, total, before = shape.views(flat), np.zeros(shape.hidden), 0.0, start
    n, of = shape.hidden, gru.Model(shape, flat).class_of
    for w in words:
        drive, pull = p["inputs"][before], h @ p["recur"]
        z, r = (1 / (1 + np.exp(-(drive[: 2 * n] + pull[: 2 * n])))).reshape(2, n)
        new = np.tanh(drive[2 * n :] + r * pull[2 * n :])
        h = (1 - z) * new + z * h
        logits = h @ p["to_class"] + p["class_bias"]
        total += logits[of[w]] - np.log(np.exp(logits).sum())
        if w < shape.n_words:
            a, b = shape.class_starts[of[w]], shape.class_starts[of[w] + 1]
            logits = h @ p["to_word"][a:b].T + p["word_bias"][a:b]
            total += logits[w - a] - np.log(np.exp(logits).sum())
        before = w
    return total


def test_state_is_carried_over_windows(model):
    shape, flat = model
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 7, size) for size in (1, 3, 40, 7, 19, 2)]
    got = gru.scores(gru.Model(shape, flat), texts, 0, lanes=2, steps=4)
    assert np.allclose(got, [plain_score(shape, flat, t, 0) for t in texts])


def test_gradient_is_that_of_differences(model):
    shape, flat = model
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 7, (2, 5, 3))
    fresh = np.zeros((5, 3), dtype=bool)
    fresh[0] = fresh[2, 1] = True
    m, h = gru.Model(shape, flat), np.zeros((3, shape.hidden))

    def loss():
        states, _ = m.run(x, fresh, h)
        return -m.log_prob(states.reshape(-1, shape.hidden), y.ravel())[0].sum()

    trace, grads = [], {k: np.zeros_like(v) for k, v in m.p.items() if k != "inputs"}
    states, _ = m.run(x, fresh, h, trace)
    _, d = m.log_prob(states.reshape(-1, shape.hidden), y.ravel(), grads)
    m.back(x, fresh, trace, d.reshape(states.shape), grads)
    rows, by_row = grads.pop("inputs")
    grads["inputs"] = np.zeros_like(m.p["inputs"])
    grads["inputs"][rows] = by_row
    for name, grad in grads.items():
        flat_view, step = m.p[name].reshape(-1), 1e-5
        for i in rng.integers(0, len(flat_view), 8):
            kept = flat_view[i]
            flat_view[i] = kept + step
            up = loss()
            flat_view[i] = kept - step
            down = loss()
            flat_view[i] = kept
            assert math.isclose((up - down) / (2 * step), grad.reshape(-1)[i], rel_tol=1e-3, abs_tol=1e-6), name


def test_probabilities_add_up(model):
    shape, flat = model
    m = gru.Model(shape, flat)
    state = np.random.default_rng(3).normal(size=(1, shape.hidden))
    logs = [m.log_prob(state, np.array([w]))[0][0] for w in range(shape.n_words + 1)]
    assert math.isclose(sum(map(math.exp, logs)), 1)


def check_counts(rows, pairs):
    held_out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in pairs if not held_out(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, text in pairs:
        words = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        want[(i, held_out(i), len(words), sum(counts[w] > 0 for w in words), total, round(base, 6))] += 1
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want


def test_odd_rows(spark, odd):
    rows = document_scores(odd, settings=SMALL).collect()
    check_counts(rows, [(r.doc_id, r.text) for r in odd.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_empty_table_and_no_training_rows(spark, odd):
    assert document_scores(odd.limit(0), settings=SMALL).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = document_scores(spark.createDataFrame([(only, "a b")], "doc_id long, text string"), settings=SMALL).collect()
    check_counts(rows, [(only, "a b")])


def test_held_out_documents_score_above_the_base(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/../sf0.01/documents.parquet").select("doc_id", "text")
    rows = document_scores(docs).collect()
    check_counts(rows, [(r.doc_id, r.text) for r in docs.collect()])
    held_out = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)


def test_shortlist_and_classes_follow_the_vocabulary(spark):
    def model_of(words):
        rows = [(f"w{i}".encode(), 10 + i % 7) for i in range(words)] + [(b"rare", 1), (b"", 5)]
        vocab = vocabulary(spark.createDataFrame(rows, "word binary, n long"), Settings(max_hot=100))
        return vocab, shape_of(vocab, Settings())

    (few, small), (many, large) = model_of(500), model_of(4_000)
    # All words that occur often enough and the end are on the shortlist, also beyond max_hot.
    assert (few.shortlist, many.shortlist) == (501, 4_001)
    assert few.tail() == (1, 1) and many.tail() == (1, 1)
    assert large.n_classes > small.n_classes and large.length() > 7 * small.length()


def test_other_partitions_give_the_same_scores(spark, sf_dir):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    docs = workspace(spark).keep(some, "documents")
    several = Settings(learner_tokens=5_000, lanes=8)

    def scored(table):
        return sorted((r.id, r.score) for r in document_scores(table, settings=several).collect())

    one, many = scored(docs.coalesce(1)), scored(docs.repartition(9))
    assert [i for i, _ in one] == [i for i, _ in many]
    assert np.allclose([s for _, s in one], [s for _, s in many], rtol=1e-5, atol=1e-4)


def test_rounds_follow_the_training_tokens():
    plans = [schedule(n, Settings()) for n in (0, 10**6, 10**8, 10**10)]
    assert plans[0] == plans[1] == (1, 1)
    assert plans[1][0] < plans[2][0] < plans[3][0] and plans[1][1] < plans[2][1] < plans[3][1]
    assert all(rounds * learners * Settings().learner_tokens >= n for (rounds, learners), n in zip(plans, (0, 10**6, 10**8, 10**10)))


def test_training_windows_hold_every_word_once():
    texts = [np.arange(n) for n in (1, 40, 3, 9)]
    x, y, owner, fresh = (np.concatenate([a.T.ravel() for a in part]) for part in zip(*gru.stream(texts, 99, lanes=4, steps=100)))
    assert y[owner >= 0].tolist() == np.concatenate(texts).tolist()
    assert fresh.sum() == len(texts) and (x[fresh] == 99).all() and (x[(owner >= 0) & ~fresh] == y[(owner >= 0) & ~fresh] - 1).all()


def test_what_learners_return_follows_the_tokens():
    settings, moved = Settings(), []
    # The model grows with the root of the input: learners of a fixed share would return ever more per token.
    for total, weights in ((10**8, 4 * 10**6), (10**10, 4 * 10**7), (10**12, 4 * 10**8)):
        rounds, learners = schedule(total, settings, weights)
        assert rounds * learners * max(settings.learner_tokens, settings.tokens_per_weight * weights) >= total
        moved.append(rounds * learners * weights / total)
    assert max(moved) < 0.5 and moved[2] < 1.3 * moved[0]


def test_rows_over_several_learners_do_not_depend_on_partitions(spark, sf_dir):
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    docs = workspace(spark).keep(some, "documents")
    several = Settings(learner_tokens=5_000, tokens_per_weight=0, lanes=8)
    one, many = (sorted((r.id, r.score) for r in document_scores(t, settings=several).collect()) for t in (docs.coalesce(1), docs.repartition(9)))
    assert [i for i, _ in one] == [i for i, _ in many]
    assert np.allclose([s for _, s in one], [s for _, s in many], rtol=1e-5, atol=1e-4)


def test_words_split_together_are_those_of_each_text():
    texts = [None, "", " a  B ", "\n\n", " \t\x0b\x0c\r ", "a\x00b \U0001f600 \u00c9 \u00c0B\x1cC\x85d e", "x"]
    words, owner = split_words(pa.array(texts, pa.string()))
    found = [[w for w, o in zip(words.to_pylist(), owner) if o == i] for i in range(len(texts))]
    assert [[*f, END] for f in found] == [tokens(t) for t in texts]


def test_many_classes_are_grouped():
    def groups_of(words):
        counts = np.full(words, 10)
        return shape_of(Vocabulary([b"%d" % i for i in range(words)], counts, words, int(counts.sum()), words), Settings())

    few, many = groups_of(1_000), groups_of(90_000)
    assert not few.group_starts
    # A step weighs few groups and few classes of one group, not all classes.
    widths = np.diff(many.group_starts)
    assert many.group_starts[-1] == many.n_classes and len(widths) + widths.max() < many.n_classes / 3


def grouped_model():
    counts = np.array([9, 7, 5, 3, 2, 1])
    return gru.Shape(gru.equal_mass_classes(counts, 3), 4, (0, 2, 4)), counts


def test_probabilities_of_a_grouped_model_add_up():
    shape, counts = grouped_model()
    m = gru.Model(shape, gru.initial(shape, counts, 8, 0).astype(np.float64))
    state = np.random.default_rng(3).normal(size=(1, shape.hidden))
    logs = [m.log_prob(state, np.array([w]))[0][0] for w in range(shape.n_words + 1)]
    assert math.isclose(sum(map(math.exp, logs)), 1)


def test_gradient_of_a_grouped_model_is_that_of_differences():
    shape, counts = grouped_model()
    m, rng = gru.Model(shape, gru.initial(shape, counts, 8, 0).astype(np.float64)), np.random.default_rng(4)
    states, y = rng.normal(size=(9, shape.hidden)), rng.integers(0, 7, 9)
    grads = {k: np.zeros_like(v) for k, v in m.p.items()}
    _, back = m.log_prob(states, y, grads)
    for name, flat, grad in [("state", states.reshape(-1), back.reshape(-1))] + [
        (k, m.p[k].reshape(-1), grads[k].reshape(-1)) for k in ("to_group", "group_bias", "to_class", "class_bias", "to_word", "word_bias")
    ]:
        for i in range(len(flat)):
            kept, sums = flat[i], []
            for step in (1e-5, -1e-5):
                flat[i] = kept + step
                sums.append(-m.log_prob(states, y)[0].sum())
            flat[i] = kept
            assert math.isclose((sums[0] - sums[1]) / 2e-5, grad[i], rel_tol=1e-3, abs_tol=1e-6), name


def test_logits_out_of_range_are_shifted():
    shape, counts = grouped_model()
    m = gru.Model(shape, gru.initial(shape, counts, 8, 0).astype(np.float32))
    for bias in (m.p["word_bias"], m.p["class_bias"], m.p["group_bias"]):
        bias += 500
    logs = [m.log_prob(np.zeros((1, 4), dtype=np.float32), np.array([w]))[0][0] for w in range(7)]
    assert math.isclose(sum(map(math.exp, logs)), 1, rel_tol=1e-4)
