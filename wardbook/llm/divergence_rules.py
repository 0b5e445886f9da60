"""Quality rules from counts and from divergence of histograms.

A document's shares of six character classes, and of its language's common words, are compared
with those of all documents in that language by Jensen-Shannon distance (base 2, 0 to 1). Short
texts have ragged histograms, so each comparison has a minimum length. A document that fails a
count rule or exceeds a distance is rejected.

Defined results: a null text has no words and fails. Documents in a language that has no list of
common words are compared by characters only, and a language whose documents are all too short
for a reference is not compared; a null language counts as a language. Repeated rows count as
often as they are there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import SPACE_RUN, SPACES, words, workspace

# Frequent words of four languages.
COMMON_WORDS: Mapping[str, Sequence[str]] = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "en": "the of and to a in is it you that he was for on are with as his they be".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au".split(),
}


@dataclass(frozen=True)
class Limits:
    """What a document may have; distances are compared from the given lengths on."""

    min_words: int = 10
    max_repeat_percent: int = 20
    min_chars_compared: int = 400
    max_char_distance: float = 0.30
    min_words_compared: int = 100
    max_word_distance: float = 0.45
    #: Both distances above these reject too: odd characters alone may be a list or a name.
    both_char_distance: float = 0.08
    both_word_distance: float = 0.25


def _windows(found: Column, width: int) -> Column:
    """A hash of each run of ``width`` words."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(found) - width),
        lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(width)]),
    )
    return F.when(F.size(found) >= width, hashes).otherwise(F.array().cast("array<bigint>"))


def with_counts(docs: DataFrame, text: str, lang: str, width: int = 5) -> DataFrame:
    """``docs`` with a struct ``m`` of counts and histograms. Other columns stay, but for those named like a step
    below (``w0`` to ``at``): ``assess`` passes rows that have none of these names.

    Each step is a column of its own, used more than once by the next, so that Spark computes
    it once per row. The sort that finds repeated windows runs for texts that have some.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    common = sorted({w for listed in COMMON_WORDS.values() for w in listed})
    own = F.coalesce(*[F.when(F.col(lang) == k, F.array(*[F.lit(w) for w in v])) for k, v in COMMON_WORDS.items()])
    lines = F.filter(F.split(full, "\n", -1), lambda line: F.char_length(F.btrim(line, F.lit(SPACES))) > 0)
    steps = (
        docs.withColumns({"w0": words(full), "l0": lines, "r1": F.regexp_replace(full, "[a-z]+", "")})
        .withColumns({"h0": _windows(F.col("w0"), width), "r2": F.regexp_replace("r1", SPACE_RUN, ""),
                      "c0": F.filter("w0", lambda w: w.isin(common))})
        .withColumns({"h1": F.when(
            F.size(F.array_distinct("h0")) < F.size("h0"),
            F.sort_array(F.transform("h0", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        )})
        .withColumns({"at": F.sort_array(F.transform(
            F.filter("h1", lambda x, k: (F.get("h1", k - 1)["h"] == x["h"]) | (F.get("h1", k + 1)["h"] == x["h"])),
            lambda x: x["i"],
        ))})
    )
    # A repeated window covers the words up to the next repeated one, at most its width.
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(width), F.coalesce(F.get("at", k + 1) - p, F.lit(width)))),
        F.lit(0), lambda a, b: a + b,
    )

    def without(classes: str) -> Column:
        return F.char_length("r2") - F.char_length(F.regexp_replace("r2", f"[{classes}]+", ""))

    chars, n_rest = F.char_length(full), F.char_length("r2")
    upper, digits, beyond = without("A-Z"), without("0-9"), without("^\\x00-\\x7F")
    measured = F.struct(
        F.size("w0").cast("long").alias("n_words"),
        (chars - F.char_length("r1") + n_rest).cast("long").alias("word_chars"),
        without("#*$%&|<>").cast("long").alias("n_symbols"),
        (F.size("l0") - F.size(F.array_distinct("l0"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.array(
            chars - F.char_length("r1"), F.char_length("r1") - n_rest, upper, digits,
            n_rest - upper - digits - beyond, beyond,
        ).cast("array<bigint>").alias("chars"),
        F.transform(own, lambda c: F.size("c0") - F.size(F.array_remove("c0", c))).cast("array<bigint>").alias("common"),
    )
    return steps.select(*[F.col(f"`{c}`") for c in docs.columns], measured.alias("m"))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)


def _histograms(m: Column) -> tuple[Column, Column]:
    """Bins that add up to all characters, and to all words."""
    return m["chars"], F.concat(m["common"], F.array(m["n_words"] - _sum(m["common"])))


def language_references(counted: DataFrame, lang: str, limits: Limits) -> DataFrame:
    """``(lang, chars, common)``: bins summed over all documents long enough to be compared."""
    chars, common = _histograms(F.col("m"))
    bins = counted.select(F.col(lang).alias("lang"), F.explode(F.array(
        F.struct(F.lit("chars").alias("kind"), F.when(_sum(chars) >= limits.min_chars_compared, chars).alias("bins")),
        F.struct(F.lit("common").alias("kind"), F.when(F.col("m.n_words") >= limits.min_words_compared, common).alias("bins")),
    )).alias("h"))
    summed = (
        bins.select("lang", "h.kind", F.posexplode("h.bins").alias("pos", "n"))
        .groupBy("lang", "kind", "pos").agg(F.sum("n").alias("n"))
        .groupBy("lang", "kind").agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("h"))
        .select("lang", "kind", F.transform("h", lambda x: x["n"]).alias("h"))
    )

    def of(kind: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col("h"))).alias(kind)

    return summed.groupBy("lang").agg(of("chars"), of("common"))


def js_distance(a: Column, b: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two arrays of counts.

    Null if either is null or has no counts.
    """
    n, k = _sum(a).cast("double"), _sum(b).cast("double")

    def part(x: Column, p: Column, q: Column) -> Column:
        return F.when(x > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    terms = F.zip_with(a, b, lambda x, y: (part(x, x / n, y / k) + part(y, y / k, x / n)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)
    return F.when((n > 0) & (k > 0), F.sqrt(F.greatest(total, F.lit(0.0))))


def judged(counted: DataFrame, references: DataFrame, lang: str, limits: Limits) -> DataFrame:
    """``counted`` with ``base_failed``, ``char_distance``, ``word_distance`` and ``kept``."""
    m, ref = F.col("m"), F.struct("chars", "common")
    named = references.select(F.col("lang").alias("ref_lang"), ref.alias("ref"))
    joined = counted.join(named, F.col(lang).eqNullSafe(F.col("ref_lang")), "left").drop("ref_lang")
    chars, common = _histograms(m)
    failed = (m["n_words"] < limits.min_words) | (
        100 * m["n_repeat_words"] > limits.max_repeat_percent * m["n_words"]
    )
    far = joined.withColumns({
        "base_failed": failed,
        "char_distance": F.when(_sum(chars) >= limits.min_chars_compared, js_distance(chars, F.col("ref.chars"))),
        "word_distance": F.when(m["n_words"] >= limits.min_words_compared, js_distance(common, F.col("ref.common"))),
    })
    chars_off, words_off = F.coalesce("char_distance", F.lit(0.0)), F.coalesce("word_distance", F.lit(0.0))
    off = (chars_off > limits.max_char_distance) | (words_off > limits.max_word_distance) | (
        (chars_off > limits.both_char_distance) & (words_off > limits.both_word_distance)
    )
    return far.withColumn("kept", ~F.col("base_failed") & ~off).drop("ref")


def assess(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits(),
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """One row per document: ``doc`` (a struct of its columns, or of those in ``carry``), its counts ``m``, distances, ``kept``.

    Documents are counted once: the counts are written, without the text unless ``doc`` holds it,
    and both the references and the verdicts come from them. References are written too, so that
    Spark knows their size when it joins them.
    """
    work = workspace(docs.sparkSession)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("doc"),
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
    )
    counted = work.keep(with_counts(rows, "text", "lang").drop("text"), "counted")
    references = work.keep(language_references(counted, "lang", limits), "references")
    return judged(counted, references, "lang", limits).drop("lang")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    return assess(docs, id_col, text_col, lang_col, limits).filter("kept").select("doc.*")
