"""Each training-data operator applied to its whole table, under the names of the contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm import (
    chunked_bpe, deobfuscation, divergence_rules, hash_index, hyperplane_dedup, importance_resampling, line_runs,
    ngram_tiles, pointer_audit, recurrent_lm, secret_ledger, sharding, source_mixing,
)
from wardbook.llm.common import workspace

#: The shards of the sharding query.
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


#: The tokenizer file of the encoding query.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document by its id."""
    docs = _read(spark, sf_dir, "documents").select("doc_id")
    return sharding.assign_shards(docs, "doc_id", SHARDS)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a model of the training documents."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return recurrent_lm.document_scores(docs).withColumnRenamed("id", "doc_id")


def op3_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Hashes of the ids of every document and of the text they decode to."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return chunked_bpe.encode(docs, vocabulary).withColumnRenamed("id", "doc_id")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return deobfuscation.personal_data(docs).withColumnRenamed("id", "doc_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict for every document."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return divergence_rules.assess(docs, carry=["doc_id"]).select(
        F.col("id").alias("doc_id"), *[f"m.{c}" for c in counts], "base_failed", "kept"
    )


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hyperplane_dedup.near_vectors(vectors).withColumnRenamed("id", "vec_id")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, from a ledger that starts empty."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secret_ledger.BlobLedger(spark, f"{workspace(spark).folder}/ledger")
    ledger.update(docs, "doc_id", "text")
    found = ledger.findings(docs, "doc_id", "text")

    def text_of(spans: Column) -> Column:
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(parts, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda s: s["kind"].isin(*secret_ledger.BASE_KINDS))
    return found.select(
        F.col("path").alias("doc_id"), *[count(kind) for kind in secret_ledger.BASE_KINDS],
        F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("findings")).alias("spans"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and the hash of what is left of every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return source_mixing.copies(docs).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_tiles.near_copies(docs).withColumnRenamed("id", "doc_id")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source of a language differs from its others, and by which terms from all of it."""
    return pointer_audit.audit(_read(spark, sf_dir, "documents").select("text", "lang", "source"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copy that stays for every document."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return hash_index.exact_copies(docs).withColumnRenamed("id", "doc_id")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of every document towards the benchmark, and the rank of those drawn."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = importance_resampling.resample(docs, _read(spark, sf_dir, "benchmark").select("text"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding, op2_lm_scoring, op3_bpe, op4_pii, op5_quality_rules, op6_embedding_near_dedup,
        op7_secret_scan, op8_line_dedup, op9_source_mixing, op10_ngram_jaccard,
        op11_source_audit, op12_exact_dedup, op13_importance_resampling,
    )
}
