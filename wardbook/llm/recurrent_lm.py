"""Document scores from a gated recurrent language model trained on the corpus.

1. Count every token of the training documents, folded per task before the shuffle.
2. Train: a hash deals training documents to rounds and to the learners of a round. A learner
   starts from the model it was sent, learns by truncated backpropagation, and returns its weights
   and the sums of squares that set its step sizes; their weighted mean is what the next round
   starts from. Every training document is used in one round. Rounds and learners both grow with
   the root of the training tokens, or slower where a larger model asks for larger shares. How the input is partitioned changes nothing.
3. Score: each whole document runs through the model with its state carried from window to
   window, so the sum of its log-probabilities is that of the complete text.

The model predicts a class of words, in two steps if there are many, and then the word within it. The shortlist has all words that
occur often enough, and grows with the corpus. Words beyond it are one class, the tail; within it a word has its add-one share of the tail's counts, and the share
left over is that of unknown words, given in full to each of them: scores are not normalised over
unseen words. Counts of frequent words travel with the code, at most
``max_hot``; those of rare ones are joined, so that neither side needs the whole vocabulary.

Defined results: a null text is an empty one and consists of its end. An id of null is trained
on. Without training documents all words are unknown. Rows may repeat.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm import gru
from wardbook.llm.common import workspace
from wardbook.sources.tables import Workspace

#: The token that ends a text; no word is empty.
END = b""


@dataclass(frozen=True)
class Settings:
    #: Words with an id of their own; None: all that occur often enough, as ``least_count`` says.
    shortlist: int | None = None
    #: None: in proportion to the square root of the shortlist.
    classes: int | None = None
    #: Classes from which on they are put in groups, so that work per word does not follow their number.
    grouped_from: int = 100
    #: Least count of a word on the shortlist, or the square root of the tokens times ``count_share`` if larger.
    min_count: int = 8
    count_share: float = 0.01
    hidden: int = 12
    #: Tokens, about, that a learner has in a round.
    learner_tokens: int = 4_000_000
    rate: float = 0.12
    #: Tokens that a learner has per number of its model, at least: what it returns follows what it reads.
    tokens_per_weight: float = 3.0
    #: Texts read side by side.
    lanes: int = 512
    steps: int = 16
    seed: int = 2
    #: Most words whose counts are sent to all tasks.
    max_hot: int = 150_000
    #: Tokens that a task holds at a time, a longer text apart.
    buffer_tokens: int = 5_000_000
    #: Distinct words that a task counts before it passes counts on.
    count_words: int = 400_000


def tokens(text: str | None) -> list[bytes]:
    """Words split at ASCII white space with A-Z in lower case, then the end."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


#: Texts that are split at once.
SPLIT_ROWS = 2_048


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as ``tokens`` has them, without the ends, and the position of each word's text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, owner = lists.flatten().cast(pa.binary()), np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    real = pc.greater(pc.binary_length(words), 0)
    return words.filter(real), owner[real.to_numpy(zero_copy_only=False)]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _count_rows(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, fresh, ends = COUNTS.empty_table(), [], 0
        for batch in batches:
            for low in range(0, len(batch), SPLIT_ROWS):
                texts = batch.column("text").slice(low, SPLIT_ROWS)
                ends += len(texts)
                found = pc.value_counts(split_words(texts)[0])
                fresh.append(pa.Table.from_arrays(found.flatten(), schema=COUNTS))
                # Counts that are new are added up once they are as many as those that are held.
                if sum(map(len, fresh)) < max(len(counts), limit // 4):
                    continue
                counts, fresh = _added_up([counts, *fresh]), []
                if len(counts) > limit:
                    yield from counts.to_batches()
                    counts = COUNTS.empty_table()
        if ends:
            yield from _added_up([counts, *fresh, pa.table([[END], [ends]], schema=COUNTS)]).to_batches()

    return run


COUNTS = pa.schema([("word", pa.binary()), ("n", pa.int64())])


def _added_up(counts: list[pa.Table]) -> pa.Table:
    sums = pa.concat_tables(counts).group_by("word", use_threads=False).aggregate([("n", "sum")])
    return sums.rename_columns({"n_sum": "n"}).select(["word", "n"]).combine_chunks()


@dataclass(frozen=True)
class Vocabulary:
    """Hot words in falling order of count, the shortlist first; totals of all training tokens."""

    words: list[bytes]
    counts: np.ndarray
    shortlist: int
    total: int
    distinct: int

    def tail(self) -> tuple[int, int]:
        """Tokens and distinct words beyond the shortlist."""
        own = self.counts[: self.shortlist]
        return self.total - int(own.sum()), self.distinct - int((own > 0).sum())


def least_count(total: int, settings: Settings) -> int:
    """How often a word must occur among ``total`` tokens to be on the shortlist.

    The model grows with the root of the input or so, and the share of tokens that it covers grows too.
    """
    return max(settings.min_count, math.ceil(math.sqrt(total) * settings.count_share))


def vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    """The driver gets the number of words per count, of which there are few, and the hot words.

    Words of a derived shortlist are hot, however many there are.
    """
    sums = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct")).first()
    per_count = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
    least, words = None, 0
    for row in per_count.toLocalIterator():
        words += row["words"]
        if words > settings.max_hot:
            break
        least = row["n"]
    often = least_count(sums["total"] or 0, settings)
    if settings.shortlist is None:
        least = often if least is None else min(least, often)
    hot = None if least is None else counts.filter(F.col("n") >= least).select("n", "word").toArrow()
    pairs = zip(hot["n"].to_pylist(), hot["word"].to_pylist()) if hot is not None else ()
    ranked = sorted(((n, word) for n, word in pairs if word != END), key=lambda r: (-r[0], r[1]))
    end = counts.filter(F.col("word") == F.lit(END)).agg(F.sum("n").alias("n")).first()["n"] or 0
    # The end is on the shortlist however rare it is.
    own = sum(n >= often for n, _ in ranked) if settings.shortlist is None else settings.shortlist - 1
    first = sorted([*ranked[:own], (end, END)], key=lambda r: (-r[0], r[1]))
    ranked = first + ranked[own:]
    return Vocabulary(
        [w for _, w in ranked], np.array([n for n, _ in ranked], dtype=np.int64), len(first),
        sums["total"] or 0, sums["distinct"],
    )


def shape_of(vocab: Vocabulary, settings: Settings) -> gru.Shape:
    own = vocab.counts[: vocab.shortlist]
    classes = settings.classes or math.ceil(0.6 * math.sqrt(len(own)))
    starts, groups = gru.equal_mass_classes(own, min(classes, len(own))), ()
    if len(starts) >= settings.grouped_from:
        counts = gru.class_counts(starts, own, vocab.tail()[0])
        groups = gru.equal_mass_classes(counts, math.isqrt(len(starts)))
    return gru.Shape(starts, settings.hidden, groups)


def schedule(total: int, settings: Settings, weights: int = 0) -> tuple[int, int]:
    """Rounds, and learners per round, for ``total`` training tokens and a model of ``weights`` numbers.

    All learners return no more than a multiple of the tokens, however large the model.
    """
    shares = max(1, math.ceil(total / max(settings.learner_tokens, settings.tokens_per_weight * weights)))
    rounds = math.isqrt(shares)
    return rounds, math.ceil(shares / rounds)


class _Indexer:
    """Positions of words among the hot ones; all others have the position after the last."""

    def __init__(self, vocab: Vocabulary):
        self.words = pa.array(vocab.words, pa.binary())
        self.rest = len(vocab.words)
        self.end = vocab.words.index(END)

    def __call__(self, texts: pa.Array) -> tuple[list[np.ndarray], pa.Array, np.ndarray]:
        """Positions of each text's words and of its end; the words that are not hot, and the position of each one's text."""
        words, owner = split_words(texts)
        found = pc.index_in(words, value_set=self.words)
        cold = found.is_null()
        # Each text before a word has an end too.
        out = np.full(len(words) + len(texts), self.end, dtype=np.int32)
        out[np.arange(len(words)) + owner] = found.fill_null(self.rest).to_numpy()
        bounds = np.cumsum(np.bincount(owner, minlength=len(texts)) + 1)
        return np.split(out, bounds[:-1]) if len(texts) else [], words.filter(cold), owner[cold.to_numpy(zero_copy_only=False)]


def _encode_rows(vocab):
    """Texts as ids of the shortlist, which is in falling order of count, so that most are small."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, shortlist = _Indexer(vocab.value), vocab.value.shortlist
        for whole in batches:
            for low in range(0, len(whole), SPLIT_ROWS):
                batch = whole.slice(low, SPLIT_ROWS)
                ids = [np.minimum(a, shortlist).tobytes() for a in index(batch.column("text"))[0]]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("round", "learner", "key")), pa.array(ids, pa.binary())],
                    ["round", "learner", "key", "ids"],
                )

    return run


def _train_rows(vocab, flat, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen, trainer = [], 0, 0, None
        for batch in batches:
            for ids in batch.column("ids"):
                if trainer is None:
                    weights, squares = np.split(flat.value.copy(), 2)
                    trainer = gru.Trainer(gru.Model(shape_of(vocab.value, settings), weights), settings.rate, squares)
                    end = vocab.value.words.index(END)
                held.append(np.frombuffer(ids.as_py(), dtype=np.int32))
                size += len(held[-1])
                if size >= settings.buffer_tokens:
                    trainer.learn(held, end, settings.lanes, settings.steps)
                    held, size, seen = [], 0, seen + size
        if held:
            trainer.learn(held, end, settings.lanes, settings.steps)
            seen += size
        if seen:
            learner, both = TaskContext.get().partitionId(), np.concatenate([weights, squares])
            for part, low in enumerate(range(0, len(both), SLICE)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([learner], pa.int32()), pa.array([seen], pa.int64()),
                    pa.array([both[low : low + SLICE].tobytes()], pa.binary()),
                ], ["part", "learner", "seen", "weights"])

    return run


#: Numbers of a model that are averaged in one place; only the mean comes to the driver.
SLICE = 65_536
WEIGHTS = "part int, learner int, seen long, weights binary"


def _mean(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("learner")
    seen = rows["seen"].to_numpy()
    total = sum(np.frombuffer(w.as_py(), dtype=gru.FLOAT) * (n / seen.sum()) for w, n in zip(rows["weights"], seen))
    return pa.table({"part": rows["part"][:1], "weights": [total.astype(gru.FLOAT).tobytes()]},
                    schema=pa.schema([("part", pa.int32()), ("weights", pa.binary())]))


def train(docs: DataFrame, vocab: Vocabulary, shared: Broadcast, settings: Settings, work: Workspace) -> np.ndarray:
    """Parameters after all rounds, from training rows ``(id, text)``; ``shared`` is the vocabulary at all tasks.

    What a round starts from is sent anew and given up after it.
    """
    context = docs.sparkSession.sparkContext
    shape = shape_of(vocab, settings)
    weights = gru.initial(shape, vocab.counts[: vocab.shortlist], vocab.tail()[0], settings.seed)
    flat = np.concatenate([weights, np.full_like(weights, 0.1)])
    rounds, learners = schedule(vocab.total, settings, len(weights))
    dealt = F.pmod("key", F.lit(rounds * learners))
    # By id and text: copies of a text go to several learners.
    rows = docs.withColumn("key", F.xxhash64("id", "text")).select(
        F.floor(dealt / learners).cast("int").alias("round"), (dealt % learners).cast("int").alias("learner"), "key", "text"
    )
    # A round reads its own part only, however many there are.
    dealt_rows = work.keep(
        rows.mapInArrow(_encode_rows(shared), "round int, learner int, key long, ids binary"), "dealt", by=("round",)
    )
    for turn in range(rounds):
        sent = context.broadcast(flat)
        # One task per learner, with its rows in an order that is theirs alone.
        means = (
            dealt_rows.filter(F.col("round") == turn).repartitionById(learners, F.col("learner"))
            .sortWithinPartitions("key", "ids").select("ids")
            .mapInArrow(_train_rows(shared, sent, settings), WEIGHTS)
            .groupBy("part").applyInArrow(_mean, "part int, weights binary").toArrow().sort_by("part")
        )
        if len(means):
            flat = np.concatenate([np.frombuffer(w.as_buffer(), dtype=gru.FLOAT) for w in means["weights"]])
        del means
        sent.destroy()
    return flat[: len(weights)]


SCORED = (
    "row long, id long, held_out boolean, n_tokens long, n_known long, n_tail long, base double, tail double,"
    " log_prob double, words array<binary>, times array<int>"
)


def _cold_lists(words: pa.Array, owner: np.ndarray, texts: int) -> tuple[pa.Array, pa.Array]:
    """Per text its distinct words of ``words``, and how often it has each; ``owner`` is in order, and groups keep it."""
    found = pa.table({"text": owner, "word": words}).group_by(["text", "word"], use_threads=False)
    found = found.aggregate([([], "count_all")]).sort_by("text").combine_chunks()
    begins = pa.array(np.searchsorted(found["text"].to_numpy(), np.arange(texts + 1)), pa.int32())
    parts = (found["word"], found["count_all"].cast(pa.int32()))
    return tuple(pa.ListArray.from_arrays(begins, pa.concat_arrays(part.chunks)) if part.num_chunks
                 else pa.ListArray.from_arrays(begins, pa.array([], part.type)) for part in parts)


def _score_rows(vocab, flat, settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocab.value
        index, model = _Indexer(known), gru.Model(shape_of(known, settings), flat.value)
        logs = np.log10(np.append(known.counts, 0) + 1.0)
        seen = np.append(known.counts > 0, False)
        row = TaskContext.get().partitionId() << 40

        def emit(held: list[tuple]) -> pa.RecordBatch:
            nonlocal row
            arrays = [a for part in held for a in part[2]]
            short = [np.minimum(a, known.shortlist) for a in arrays]
            scored = gru.scores(model, short, index.end, settings.lanes, settings.steps)
            columns = [
                pa.array(np.arange(row, row + len(arrays))), pa.concat_arrays([part[0] for part in held]),
                pa.concat_arrays([part[1] for part in held]), pa.array([len(a) for a in arrays], pa.int64()),
                pa.array([int(seen[a].sum()) for a in arrays], pa.int64()),
                pa.array([int((s == known.shortlist).sum()) for s in short], pa.int64()),
                pa.array([float(logs[a].sum()) for a in arrays]),
                pa.array([float(logs[a[a >= known.shortlist]].sum()) for a in arrays]), pa.array(scored),
                *(pa.concat_arrays([part[i] for part in held]) for i in (3, 4)),
            ]
            row += len(arrays)
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCORED.split(", ")])

        held, size = [], 0
        for whole in batches:
            for low in range(0, len(whole), SPLIT_ROWS):
                batch = whole.slice(low, SPLIT_ROWS)
                arrays, cold, owner = index(batch.column("text"))
                cold = _cold_lists(cold, owner, len(batch))
                done = 0
                for i, array in enumerate(arrays, 1):
                    size += len(array)
                    if size >= settings.buffer_tokens or i == len(arrays):
                        part = slice(done, i)
                        held.append((batch.column("id")[part], batch.column("held_out")[part], arrays[part], *(c[part] for c in cold)))
                        done = i
                    if size >= settings.buffer_tokens:
                        yield emit(held)
                        held, size = [], 0
        if held:
            yield emit(held)

    return run


def document_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """Per row ``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, in log10."""
    work, context = workspace(docs.sparkSession), docs.sparkSession.sparkContext
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"),
    )
    training = rows.filter(~F.col("held_out")).select("id", "text")
    counts = work.keep(
        training.select("text").mapInArrow(_count_rows(settings.count_words), "word binary, n long")
        .groupBy("word").agg(F.sum("n").alias("n")), "counts",
    )
    vocab = vocabulary(counts, settings)
    shared = context.broadcast(vocab)
    sent = context.broadcast(train(training, vocab, shared, settings, work))
    scored = work.keep(rows.mapInArrow(_score_rows(shared, sent, settings), SCORED), "scored")
    sent.destroy()
    shared.destroy()
    cold = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times")
    )
    n = F.coalesce("n", F.lit(0))
    rest = cold.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + 1)).alias("cold"), F.sum(F.when(n > 0, F.col("times"))).alias("cold_known")
    )
    tail_tokens, tail_words = vocab.tail()
    cold_log = F.coalesce("cold", F.lit(0.0))
    base = F.col("base") + cold_log - F.col("n_tokens") * float(np.log10(vocab.total + vocab.distinct + 1))
    tail = F.col("tail") + cold_log - F.col("n_tail") * float(np.log10(tail_tokens + tail_words + 1))
    return scored.join(rest, "row", "left").select(
        "id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("cold_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("log_prob") / float(np.log(10)) + tail).alias("score"),
    )
