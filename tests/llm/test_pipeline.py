"""The pipeline against plain versions of its stages."""

import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from wardbook.llm.common import workspace
from wardbook.llm.oracles import ORACLES

COLUMNS = "doc_id, text, lang, source, n_chars"


def plain_stages(sf_dir):
    """What the first three stages keep, as ``(doc_id, source, text)``."""
    duck = duckdb.connect()
    duck.execute(f"CREATE TABLE documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    good = duck.sql(f"SELECT doc_id FROM ({ORACLES['op5_quality_rules']}) WHERE kept").fetchall()
    duck.execute("CREATE TABLE good AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?))", [[r[0] for r in good]])
    duck.execute("DROP TABLE documents")
    rows, seen = [], {}
    for doc_id, text, source in duck.sql("SELECT doc_id, text, source FROM good ORDER BY doc_id").fetchall():
        kept = []
        for line in text.split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r")
            key = "".join(c.lower() if c.isascii() else c for c in key)
            if len(key) < 10 or seen.setdefault(key, doc_id) == doc_id:
                kept.append(line)
        rows.append((doc_id, source, "\n".join(kept)))
    duck.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    columns = "doc_id, component_id"
    heads = {i for i, component in duck.sql(f"SELECT {columns} FROM ({ORACLES['op10_ngram_jaccard']})").fetchall() if i == component}
    return [r for r in rows if r[0] in heads]


def test_pipeline_equals_plain_stages(spark, sf_dir):
    kept = plain_stages(sf_dir)
    docs, work = spark.read.parquet(f"{sf_dir}/documents.parquet"), workspace(spark)
    tables = []
    for name, stage in corpus_pipeline.STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
        tables.append(docs)
    assert all(", ".join(t.columns) == COLUMNS for t in tables[:-1])
    found, result = tables[2].collect(), tables[-1].collect()
    assert sorted((r.doc_id, r.source, r.text) for r in found) == sorted(kept)
    assert all(r.n_chars == len(r.text) for r in found)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    times, text_of = Counter(r.doc_id for r in result), {i: t for i, _, t in kept}
    assert set(times) <= set(text_of) and max(times.values()) <= 3
    for r in result:
        ids = tokenizer.encode(text_of[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(text_of[r.doc_id].encode()).hexdigest()

    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for doc_id, source, text in kept:
        size = len(text.encode().split())
        sizes[source] += size
        taken[source] += size * times[doc_id]
        largest[source] = max(largest[source], size)
    total, order = sum(sizes.values()), sorted(sizes)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    level, full = 0.0, set()
    while True:  # sources that reach three times their size stop, and the others share again
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weights[s] for s in order if s not in full)
        over = {s for s in order if s not in full and level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    for s in order:
        target = 3 * sizes[s] if s in full else level * weights[s]
        assert math.isclose(taken[s], target, abs_tol=largest[s] + 1e-6)


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixing", "encoding"]
