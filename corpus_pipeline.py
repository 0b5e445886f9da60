"""The training-data pipeline: quality rules, line dedup, near-duplicate join, mixing, encoding.

``STAGES`` are its steps in order; each takes ``(spark, docs, sf_dir)`` and works on all that the
step before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm import chunked_bpe, divergence_rules, line_runs, ngram_tiles, source_mixing
from wardbook.llm.common import workspace

#: The tokenizer file of the last stage.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return divergence_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has; ``n_chars`` follows the text."""
    cut = line_runs.dedup_lines(docs)
    recounted = F.char_length("text").cast("long").alias("n_chars")
    return cut.select(*[recounted if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id."""
    return ngram_tiles.keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return source_mixing.mix_sources(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document, with hashes of the ids and of the text they decode to."""
    encoded = chunked_bpe.encode(docs, VOCABULARY, with_ids=True)
    return encoded.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing),
    ("encoding", encoding),
]

#: SQL has no BPE; ``tests/llm/test_pipeline.py`` holds the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again by the next."""
    work = workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
