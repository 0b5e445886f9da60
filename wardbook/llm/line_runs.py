"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line without outer white space and with A-Z in lower case. The runs hold
each key's hash once, with the first document that had it. Documents come in batches by id: a
batch anti-joins the runs, and what is new becomes a run of level 0. As soon as a level has
``fan_in`` runs they are merged into one run of the next level, so a key is rewritten once per
level and never more than ``fan_in`` runs wait on any level.

Defined results: a null or empty text is one empty line. Documents without an id are taken for
one document after all others. Rows that repeat an id are one document, so they do not cost each
other lines. Keys below ``min_chars`` code points never drop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import SPACES, ascii_lower, text_hash, unused_name, workspace

#: What a missing id counts as: after every other id.
LAST_ID = 2**63 - 1


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(doc, row, pos, h)``: every line that is long enough to be dropped, without its text."""
    return (
        docs.select(
            F.coalesce(F.col(id_col), F.lit(LAST_ID)).alias("doc"),
            text_hash(F.col(text_col)).alias("row"),
            F.posexplode(lines_of(F.col(text_col))).alias("pos", "line"),
        )
        .select("doc", "row", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select("doc", "row", "pos", F.unhex(F.md5("key")).alias("h"))
    )


class LineRuns:
    """Sorted runs ``(h, doc)`` on levels; a hash lies in one run only."""

    def __init__(self, work, fan_in: int = 3):
        if fan_in < 2:
            raise ValueError("fan_in must be at least 2")
        self.work, self.fan_in = work, fan_in
        self.levels: list[list[DataFrame]] = [[]]
        self.written = 0

    def known(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def add(self, lines: DataFrame) -> None:
        """Take in a batch whose ids all come after those of earlier batches."""
        firsts = lines.groupBy("h").agg(F.min("doc").alias("doc"))
        known = self.known()
        fresh = firsts if known is None else firsts.join(known.hint("merge"), "h", "left_anti")
        self._write(fresh.sortWithinPartitions("h"), 0)
        self._compact()

    def _write(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(self.work.keep(run, f"run-{level}-{self.written}"))
        self.written += 1

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fan_in:
                merged = reduce(DataFrame.unionByName, self.levels[level])
                self.levels[level] = []
                self._write(merged.repartition("h").sortWithinPartitions("h"), level + 1)
            level += 1


def batch_bounds(docs: DataFrame, id_col: str, batches: int) -> list[int]:
    """Ids that end each batch but the last; quantiles, so that batches are of like size."""
    shares = [i / batches for i in range(1, batches)]
    if not shares:
        return []
    row = docs.agg(F.percentile_approx(id_col, shares, 1000).alias("q")).first()
    return sorted(set(row["q"] or []))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    batches: int = 4,
    fan_in: int = 3,
) -> DataFrame:
    """``docs`` with two more columns, ``n_lines`` before and ``n_dropped``, and shorter texts.

    A line goes if an earlier document has its key. A text that loses nothing stays as it is,
    null included. Columns of those two names are replaced.
    """
    work = workspace(docs.sparkSession)
    lines = work.keep(keyed_lines(docs, id_col, text_col, min_chars), "lines")
    runs, low = LineRuns(work, fan_in), None
    for high in [*batch_bounds(docs, id_col, batches), None]:
        batch = lines
        if low is not None:
            batch = batch.filter(F.col("doc") > low)
        if high is not None:
            batch = batch.filter(F.col("doc") <= high)
        runs.add(batch)
        low = high
    firsts = runs.known().withColumnRenamed("doc", "first")
    drops = (
        lines.join(firsts, "h").filter(F.col("first") < F.col("doc"))
        .groupBy("doc", "row").agg(F.collect_set("pos").alias("drop"))
    )
    return without_lines(docs, drops, id_col, text_col)


def without_lines(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Cut the line numbers in ``drop`` out of the row that has this id and text."""
    doc, row, drop, cut, keep = (
        unused_name(docs.columns, f"__{n}") for n in ("doc", "row", "drop", "cut", "keep")
    )
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.withColumns({
        doc: F.coalesce(F.col(id_col), F.lit(LAST_ID)), row: text_hash(F.col(text_col)),
    }).join(drops.toDF(doc, row, drop), [doc, row], "left")
    split = joined.withColumn(cut, lines_of(F.col(text_col)))
    kept = split.withColumn(keep, F.when(
        F.col(drop).isNotNull(),
        F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col(drop)),
    ))
    shorter = F.when(
        F.col(drop).isNull(), F.col(text_col)
    ).otherwise(F.array_join(F.transform(F.col(keep), lambda i: F.get(F.col(cut), i)), "\n"))
    return kept.select(
        *[shorter.alias(c) if c == text_col else F.col(f"`{c}`") for c in others],
        F.size(cut).cast("long").alias("n_lines"),
        F.coalesce(F.size(drop), F.lit(0)).cast("long").alias("n_dropped"),
    )
