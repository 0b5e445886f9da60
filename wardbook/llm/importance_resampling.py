"""Importance resampling towards a target distribution of hashed n-grams.

Texts of a batch are joined into one buffer, a sentinel that no word may contain after each, so
one regex pass finds the words of all. A search of the words' places among the documents' offsets says
which document a word is in, and an n-gram whose first and last word differ in that is masked.
Buckets are then counted by one bincount, over the batch or per document. Spark adds up the
counts of both corpora; the gain of a bucket is the log of its smoothed shares' ratio, and a
document weighs the mean gain of its n-grams. Gumbel noise, from a hash of the id, makes the
highest scores a draw without replacement in proportion to the weights.

Ranks need no global sort. A score is a whole number in a range that the gains and the noise
bound, so there are at most some 10^5 scores at any input size: their counts, added up from above,
say where each score's ranks begin, and only documents of one score are sorted, by id.

Defined results: a null text has no words. Rows that repeat an id are documents of their own, with the
same noise; equal ones share neighbouring ranks. A null id takes the noise of an empty one and
comes last among equals. Without eligible documents nothing is drawn.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.common import workspace
from wardbook.llm.shingles import slices

# Words are runs of digits, letters as lower case, and bytes of other characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: No word holds it. A text that does is cut there like at any other mark.
SENTINEL = b"\x00"
BATCH_CHARS = 1 << 22


@dataclass(frozen=True)
class Settings:
    """Features are runs of one to ``max_n`` words; ``scale`` is what gains and noise are times before rounding down."""

    max_n: int = 1
    buckets: int = 10_000
    scale: int = 1000
    min_words: int = 20
    percent: int = 10
    seed: int = 2024


def features(texts: list[str | None], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and of every feature the text it is in and its bucket."""
    encoded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.cumsum([0] + [len(e) + 1 for e in encoded[:-1]])
    words, starts = [], []
    for match in WORD.finditer(SENTINEL.join(encoded).translate(LOWER)):
        words.append(match.group())
        starts.append(match.start())
    text_of = np.searchsorted(offsets, np.array(starts, dtype=np.int64), side="right") - 1
    hashes = list(map(crc32, words))
    owners, buckets = [text_of], [np.array(hashes, dtype=np.int64) % settings.buckets]
    for n in range(2, settings.max_n + 1):
        hashes = [crc32(word, crc32(b" ", before)) for before, word in zip(hashes, words[n - 1 :])]
        inside = text_of[: len(hashes)] == text_of[n - 1 :]
        owners.append(text_of[: len(hashes)][inside])
        buckets.append(np.array(hashes, dtype=np.int64)[inside] % settings.buckets)
    return np.bincount(text_of, minlength=len(texts)), np.concatenate(owners), np.concatenate(buckets)


def _count_rows(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(settings.buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in slices(texts, BATCH_CHARS):
                counts += np.bincount(features(texts[part], settings)[2], minlength=settings.buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(counts[held], pa.int64())], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``(bucket, n)`` over all texts; a task sends one row per bucket at most."""
    rows = texts.select(F.col(text_col).alias("text")).mapInArrow(_count_rows(settings), "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], settings: Settings) -> list[int]:
    """Per bucket the rounded log ratio of its share of the target to that of the source."""
    n, wanted = sum(source.values()), sum(target.values())
    return [
        math.floor(settings.scale * math.log(
            (target.get(b, 0) + 1) * (n + settings.buckets) / ((source.get(b, 0) + 1) * (wanted + settings.buckets))
        ))
        for b in range(settings.buckets)
    ]


def _weight_rows(gain: list[int], settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worth = np.array(gain, dtype=np.float64)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in slices(texts, BATCH_CHARS):
                words, owners, buckets = features(texts[part], settings)
                n = np.bincount(owners, minlength=len(words))
                total = np.bincount(owners, worth[buckets], minlength=len(words)).astype(np.int64)  # whole, below 2^53
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(part.start, len(words)), pa.array(words, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(np.floor_divide(total, np.maximum(n, 1)), pa.int64()),
                ], ["id", "n_words", "n_features", "weight"])

    return run


def weigh(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """``(id, n_words, n_features, weight, score)`` per row of ``docs``."""
    source_counts, target_counts = (
        {r["bucket"]: r["n"] for r in bucket_counts(texts, col, settings).collect()}  # a row per bucket at most
        for texts, col in ((docs, text_col), (target, target_text_col))
    )
    gain = gains(source_counts, target_counts, settings)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    draw = (F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))
    noise = F.floor(F.lit(-settings.scale) * F.log(-F.log(draw)))
    return rows.mapInArrow(
        _weight_rows(gain, settings), "id long, n_words long, n_features long, weight long"
    ).withColumn("score", F.col("weight") + noise)


def rank_highest(scored: DataFrame, eligible: str, percent: int) -> DataFrame:
    """``scored`` with ``rank`` among the drawn: ``percent`` of the eligible rows, those of the highest score.

    ``scored`` is a written table with ``id`` and whole-number ``score``.
    """
    wanted = F.call_function("div", F.sum("n").over(Window.partitionBy()) * percent, F.lit(100))
    above = F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")
    levels = scored.filter(eligible).groupBy("score").agg(F.count("*").alias("n")).select(
        "score", above.alias("above"), wanted.alias("wanted")
    )
    joined = scored.withColumn("able", F.expr(eligible)).join(F.broadcast(levels), "score", "left")
    near = F.col("able") & (F.col("above") < F.col("wanted"))
    order = [F.asc_nulls_last("id"), *[F.col(c) for c in scored.columns if c not in ("id", "score")]]
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy(*order))
    ranked = joined.filter(near).withColumn("place", place).withColumn(
        "rank", F.when(F.col("place") <= F.col("wanted"), F.col("place")).cast("long")
    )
    others = joined.filter(~F.coalesce(near, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    columns = [*scored.columns, "rank"]
    return ranked.select(*columns).unionByName(others.select(*columns))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """``(id, n_words, n_features, weight, score, rank)`` per row of ``docs``; ``rank`` is null where it is not drawn."""
    work = workspace(docs.sparkSession)
    scored = work.keep(weigh(docs, target, id_col, text_col, target_text_col, settings), "scored")
    return rank_highest(scored, f"n_words >= {settings.min_words}", settings.percent)
