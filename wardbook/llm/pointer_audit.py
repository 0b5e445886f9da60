"""Source divergence audit by sorting pointers to token starts.

A shard of texts is one byte buffer, its documents ordered by language and source. Every token is
a pointer into it, and a multikey sort orders the pointers by the bytes they point at, eight at a
time: pointers that agree so far are a segment, and only segments that go on are sorted by their
next bytes. Pointers to equal tokens then form a run, in which each source's pointers, and in
these each document's, stand side by side: where a run changes source or document is all that
counts and document frequencies need. Spark adds up the shards and does the rest.

The audit compares each source's smoothed term rates with the other sources of its language, and
with the language. Terms that a source lacks have one rate there, so sums over all terms are
split: a source's own terms against the other's rate of lacking terms, from a histogram of its
rates, then a correction for terms that both have, and the rest at once. Nothing is expanded to
all terms times all sources.

Defined results: null text, language and source are empty strings. Rows are documents, also
where they repeat an id. A group without kept terms takes part with rates of lacking terms. All
arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.common import workspace
from wardbook.llm.shingles import slices
from wardbook.sources.tables import Workspace

#: Characters of a shard; a longer text is a shard of its own.
SHARD_CHARS = 1 << 23
#: Bytes after which the few tokens that still agree are sorted by all of their bytes.
LONG_TOKEN = 128

# Tokens are runs of ASCII letters, as lower case, and bytes of other characters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[97:123] = True
_TOKEN[128:] = True

COUNTS = "lang string, source string, term string, n long, n_docs long"


def token_pointers(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every token in lower-cased bytes."""
    edges = np.flatnonzero(np.diff(_TOKEN[raw].astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _slice_keys(windows: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Bytes ``depth`` to ``depth + 8`` of each token as a number, zeros after its end."""
    at = np.minimum(starts + depth, len(windows) - 1)
    keys = windows[at].view(">u8").ravel().astype(np.uint64)
    missing = np.clip(8 - (ends - starts - depth), 0, 8).astype(np.uint64) * np.uint64(8)
    gone = missing == 64
    missing[gone] = 0
    keys = (keys >> missing) << missing
    keys[gone] = 0
    return keys


def multikey_sort(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of tokens by their bytes, equal ones by place, and where each run of equals begins."""
    n = len(starts)
    order, first = np.arange(n), np.zeros(n, dtype=bool)
    if not n:
        return order, first
    windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([raw, np.zeros(8, dtype=np.uint8)]), 8)
    first[0] = True
    open_at, depth = np.arange(n), 0  # places in ``order`` that the next bytes may part
    while len(open_at):
        tokens = order[open_at]
        segment = np.cumsum(first[open_at])
        if depth >= LONG_TOKEN:
            data = raw.tobytes()
            whole = [data[s:e] for s, e in zip(starts[tokens].tolist(), ends[tokens].tolist())]
            inner = np.array(sorted(range(len(tokens)), key=lambda i: (segment[i], whole[i])), dtype=np.int64)
            same = [whole[a] == whole[b] for a, b in zip(inner[1:].tolist(), inner[:-1].tolist())]
            parted = np.concatenate([[True], ~np.array(same, dtype=bool)])
            order[open_at] = tokens[inner]
            first[open_at] |= parted
            break
        keys = _slice_keys(windows, starts[tokens], ends[tokens], depth)
        inner = np.lexsort((keys, segment)) if depth else np.argsort(keys, kind="stable")
        tokens, keys, segment = tokens[inner], keys[inner], segment[inner]
        order[open_at] = tokens
        first[open_at[1:]] |= keys[1:] != keys[:-1]
        depth += 8
        segment = np.cumsum(first[open_at]) - 1
        goes_on = (ends[tokens] - starts[tokens]) > depth
        wanted = (np.bincount(segment) > 1) & (np.bincount(segment, goes_on) > 0)
        open_at = open_at[wanted[segment]]
    return order, first


def _gathered(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The tokens as strings, copied from buffer to buffer."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(raw[at].tobytes())
    ).cast(pa.string())


def shard_counts(groups: list[tuple[str, str]], texts: list[str]) -> pa.RecordBatch:
    """``COUNTS`` rows of one shard."""
    by_group = sorted(range(len(texts)), key=lambda i: groups[i])
    names = sorted(set(groups))
    number = {g: i for i, g in enumerate(names)}
    encoded = [texts[i].encode("utf-8", "surrogatepass") for i in by_group]
    group_of = np.array([number[groups[i]] for i in by_group], dtype=np.int64)
    raw = _LOWER[np.frombuffer(b"\n".join(encoded), dtype=np.uint8)]
    doc_starts = np.cumsum([0] + [len(e) + 1 for e in encoded[:-1]])
    starts, ends = token_pointers(raw)
    order, first = multikey_sort(raw, starts, ends)
    starts, ends = starts[order], ends[order]
    doc = np.searchsorted(doc_starts, starts, side="right") - 1
    group = group_of[doc]
    new_group, new_doc = first.copy(), first.copy()
    new_group[1:] |= group[1:] != group[:-1]
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new_group)
    counts = np.diff(np.append(at, len(starts)))
    docs = np.add.reduceat(new_doc.astype(np.int64), at) if len(at) else counts
    which = pa.array(group[at])
    return pa.RecordBatch.from_arrays([
        pa.array([n[0] for n in names], pa.string()).take(which), pa.array([n[1] for n in names], pa.string()).take(which),
        _gathered(raw, starts[at], ends[at]), pa.array(counts, pa.int64()), pa.array(docs, pa.int64()),
    ], ["lang", "source", "term", "n", "n_docs"])


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        groups = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        for part in slices(texts, SHARD_CHARS):
            yield shard_counts(groups[part], texts[part])


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, term, n, n_docs)``: occurrences and documents of every term in every source."""
    rows = docs.select(*[
        F.coalesce(F.col(c), F.lit("")).alias(name)
        for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ])
    return rows.mapInArrow(_count_rows, COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")
    )


def _kept_terms(docs: DataFrame, min_docs: int, work: Workspace, **cols: str) -> DataFrame:
    """``(lang, term, source, n, lang_n, leads)`` of terms in enough documents of their language.

    ``leads`` marks one row per term and language. A term meets its sources only after these are
    added up, so a frequent word is no hot key.
    """
    of_term = Window.partitionBy("lang", "term")
    counted = term_counts(docs, **cols).withColumns({
        "lang_n": F.sum("n").over(of_term), "in_docs": F.sum("n_docs").over(of_term),
        "leads": F.col("source") == F.min("source").over(of_term),
    })
    kept = counted.filter(F.col("in_docs") >= min_docs).select("lang", "term", "source", "n", "lang_n", "leads")
    return work.keep(kept, "terms")


def _rate(n: Column, total: Column, terms: Column, scale: int) -> Column:
    """Smoothed share of ``n`` in ``total``, in parts of ``scale``; exact for any long."""
    wide = (n + 1).cast("decimal(20,0)") * F.lit(scale).cast("decimal(18,0)")
    return F.lit(1).cast("long") + F.call_function("div", wide, (total + terms).cast("decimal(20,0)"))


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pair_sums(rates: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, other, value)``: distances summed over all kept terms, per ordered pair.

    ``rates`` has ``p`` for the terms of a source and ``p0`` for those it lacks, ``groups`` has
    ``p0``, the number of terms the source has, and ``v``, that of its language.
    """
    left, right = (
        groups.select("lang", F.col("source").alias(f"s{i}"), F.col("p0").alias(f"p0{i}"), F.col("held").alias(f"held{i}"), "v")
        for i in (1, 2)
    )
    pairs = left.join(right.drop("v"), "lang").filter("s1 <> s2")

    # The terms of one source against the other's rate of lacking terms, and the other way round.
    bins = rates.groupBy("lang", "source", "p").agg(F.count("*").alias("k")).withColumnRenamed("source", "s1")
    lone = bins.join(right.drop("v"), "lang").filter("s1 <> s2").groupBy("lang", "s1", "s2").agg(
        F.sum(F.col("k") * _distance(F.col("p"), F.col("p02"))).alias("to"),
        F.sum(F.col("k") * _distance(F.col("p02"), F.col("p"))).alias("fro"),
    )

    # Terms that both have: their distance instead of the two that ``lone`` counted.
    one, two = (
        rates.select("lang", "term", F.col("source").alias(f"s{i}"), F.col("p").alias(f"p{i}"), F.col("p0").alias(f"p0{i}"))
        for i in (1, 2)
    )
    p, q, p0, q0 = F.col("p1"), F.col("p2"), F.col("p01"), F.col("p02")
    both = one.join(two, ["lang", "term"]).filter("s1 < s2").groupBy("lang", "s1", "s2").agg(
        F.count("*").alias("shared"),
        F.sum(_distance(p, q) - _distance(p, q0) - _distance(p0, q)).alias("there"),
        F.sum(_distance(q, p) - _distance(q, p0) - _distance(q0, p)).alias("back"),
    )
    either = both.select("lang", F.explode(F.array(
        F.struct(F.col("s1").alias("s1"), F.col("s2").alias("s2"), "shared", F.col("there").alias("more")),
        F.struct(F.col("s2").alias("s1"), F.col("s1").alias("s2"), "shared", F.col("back").alias("more")),
    )).alias("e")).select("lang", "e.*")

    def own(name: str) -> Column:
        return F.coalesce(name, F.lit(0))

    back = lone.select("lang", F.col("s1").alias("s2"), F.col("s2").alias("s1"), "fro")
    lacking = F.col("v") - F.col("held1") - F.col("held2") + own("shared")
    return (
        pairs.join(lone.drop("fro"), ["lang", "s1", "s2"], "left").join(back, ["lang", "s1", "s2"], "left")
        .join(either, ["lang", "s1", "s2"], "left")
        .select(
            "lang", F.col("s1").alias("source"), F.col("s2").alias("other"),
            F.when(F.col("v") == 0, F.lit(0)).otherwise(
                own("to") + own("fro") + own("more") + lacking * _distance(p0, q0)
            ).cast("long").alias("value"),
        )
    )


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 3,
    top: int = 200,
    scale: int = 1_000_000_000,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: divergences of sources, and their leading terms.

    Part ``pair`` ranks the other sources of the language by the distance to each, part ``term``
    the ``top`` terms that the source has more often than its language.
    """
    work = workspace(docs.sparkSession)
    cols = {"lang_col": lang_col, "source_col": source_col, "text_col": text_col}
    kept = _kept_terms(docs, min_docs, work, **cols)
    named = docs.select(F.coalesce(lang_col, F.lit("")).alias("lang"), F.coalesce(source_col, F.lit("")).alias("source"))
    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count("*").alias("held"),
        F.sum(F.when(F.col("leads"), F.col("lang_n"))).alias("led_n"), F.count(F.when(F.col("leads"), 1)).alias("led"),
    )
    langs = sums.groupBy("lang").agg(F.sum("led").alias("v"), F.sum("led_n").alias("lang_total"))
    groups = (
        named.distinct().join(sums.select("lang", "source", "total", "held"), ["lang", "source"], "left")
        .join(langs, "lang", "left").na.fill(0, ["total", "held", "v", "lang_total"])
    )
    p0 = F.when(F.col("v") > 0, _rate(F.lit(0).cast("long"), F.col("total"), F.col("v"), scale)).otherwise(F.lit(1))
    groups = work.keep(groups.withColumn("p0", p0.cast("long")), "groups")
    rates = work.keep(
        kept.join(groups, ["lang", "source"]).select(
            "lang", "term", "source", "p0", _rate(F.col("n"), F.col("total"), F.col("v"), scale).alias("p"),
            _rate(F.col("lang_n"), F.col("lang_total"), F.col("v"), scale).alias("q"),
        ), "rates",
    )

    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = _pair_sums(rates, groups).select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value")
    terms = rates.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _distance(F.col("p"), F.col("q")).alias("value"),
    )
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(
        terms.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    )
