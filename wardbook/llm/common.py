"""What several training-data operators share: word pattern, row identity, work tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardbook.sources.tables import query_workspace as workspace  # noqa: F401

# White space that separates words, the pattern of a word, A-Z and its lower case.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for an empty text, null for null."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def text_hash(text: Column) -> Column:
    """64 bits of a text. Rows that agree in id and in this hash are taken for the same row."""
    return F.xxhash64(F.lit("text"), text)


def unused_name(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, lengthened until no column has this name in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
