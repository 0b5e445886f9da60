"""Personal data behind disguises, with offsets into the source text.

Three transducers rewrite a text and keep, for each character they write, the source range it
stands for: look-alike characters become ASCII and invisible ones go; spelled digits become
digits, also single ones within a number that starts with a plus sign; "(at)", "dot" and, between a name and a host,
"at" become signs. The detectors then run on the rewritten text as they do on
the source, and what they find in rewritten places maps back to source characters. Spans found
in the source itself always stay; a mapped one is added if it meets no such span of its kind.

Defined results: a null text is an empty one. Work and memory are in proportion to the text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.spans import Span, digest, joined, ordered

# Kinds in the order of the contract, and the patterns of the base spans.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Letters of other scripts that look like Latin ones, as pairs; look-alike signs.
LOOK_ALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁԛԝһΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινρχ",
    "ABESIJKMHOPCTYXaesijopcyxdqwhABEZHIKMNOPTYXoivpx",
)) | {"∙": ".", "·": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " "}
# Digits as words in four languages.
DIGIT_WORDS = {
    word: str(digit)
    for listed in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
        "zéro un deux trois quatre cinq six sept huit neuf",
    )
    for digit, word in enumerate(listed.split())
} | {"oh": "0"}

_WORDS = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_GAP = r"(?:\s*[,/-]\s*|\s+)"
#: At least four spelled digits, with "dot" between some and "plus" before the first.
SPELLED = re.compile(rf"(?<!\w)(?:plus{_GAP})?(?:{_WORDS})(?:{_GAP}(?:(?:dot|point|punkt|punto){_GAP})?(?:{_WORDS})){{3,}}(?!\w)", re.I)
SPELLED_PART = re.compile(rf"(?P<gap>{_GAP})|(?P<plus>plus)|(?P<dot>dot|point|punkt|punto)|(?P<digit>{_WORDS})", re.I)
AT_BRACKETED = re.compile(r"\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*", re.I)
DOT_BRACKETED = re.compile(r"\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*", re.I)
#: "name at host dot org": the words count only where both come in this order.
WORDED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?P<at>\s+at\s+|@)[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?P<dots>(?:\s+dot\s+[A-Za-z0-9-]+)+)",
    re.I,
)
DOT_WORD = re.compile(r"\s+(?:dot|point|punkt|punto)\s+", re.I)
#: Four numerals with a worded dot between each.
WORDED_IP = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\s+(?:dot|point|punkt|punto)\s+[0-9]{1,3}){3}(?!\w)", re.I)
#: "name at host.org", the host with its own dots.
WORDED_AT = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?P<name>[A-Za-z0-9._%+-]+)(?P<at>\s+at\s+)(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,6}(?![A-Za-z0-9-]|\.[A-Za-z0-9])", re.I)
#: A number that starts with a plus sign and has some of its digits spelled.
MIXED = re.compile(rf"\+[0-9](?:[\x20().-]*(?:[0-9]|(?<![^\W\d_])(?:{_WORDS})(?![^\W\d_])))+", re.I)
DIGIT_WORD = re.compile(rf"(?<![^\W\d_])(?:{_WORDS})(?![^\W\d_])", re.I)
DISGUISED = re.compile(
    r"[\[({<]\s*(?:at|@|dot|\.)\s*[\])}>]|\s(?:dot|point|punkt|punto)\s|\sat\s+(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2}", re.I)
# Words that stand before "at" and a host in plain prose, so that they are no names.
BEFORE_AT = frozenset(
    "a access and are available be been by find for found here him host hosted i in info is it join live located look"
    " looked looking me meet met more on online or out page post posted published read register see seen she sign site"
    " start stay stored that the them there this up us visit was we website were work works you".split()
)


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """An address starts where the run of name characters before its ``@`` starts, or where the last one ended."""
    done = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield Span("email", start, m.end())
            done = m.end()


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def detect(text: str) -> list[Span]:
    """Base spans: leftmost and non-overlapping per kind, failing matches dropped."""
    spans = list(_emails(text)) if "@" in text else []
    spans += [Span("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            spans.append(Span("card", m.start(), m.end()))
    if "+" in text:
        spans += [Span("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return ordered(spans, KINDS)


@lru_cache(maxsize=65536)
def plain(char: str) -> str | None:
    """The ASCII that a character stands for, empty for an invisible one, None for any other."""
    if char < "\x80":
        return None
    if char in LOOK_ALIKES:
        return LOOK_ALIKES[char]
    if unicodedata.category(char) == "Cf":
        return ""
    digit = unicodedata.digit(char, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", char)
    return folded if len(folded) == 1 and folded < "\x80" else None


class Rewritten:
    """A text under edits; ``low`` and ``high`` give each character's range in the source."""

    def __init__(self, text: str):
        self.text = text
        self.low, self.high = list(range(len(text))), list(range(1, len(text) + 1))
        self.edited = bytearray(len(text))

    def apply(self, edits: Iterable[tuple[int, int, str]]) -> None:
        """Replace ranges, in order and without overlap, by at most a few characters each."""
        out, low, high, edited, done = [], [], [], bytearray(), 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            out.append(self.text[done:start])
            low += self.low[done:start]
            high += self.high[done:start]
            edited += self.edited[done:start]
            if new:
                out.append(new)
                low += [self.low[start]] * len(new)
                high += [self.high[end - 1]] * len(new)
                edited += b"\x01" * len(new)
            elif end > start and edited:
                edited[-1] = 1  # what is cut out marks its neighbour
            done = end
        self.text, self.low, self.high, self.edited = "".join(out), low, high, edited


def _spelled_edits(text: str) -> Iterator[tuple[int, int, str]]:
    for run in SPELLED.finditer(text):
        for m in SPELLED_PART.finditer(text, run.start(), run.end()):
            new = {"gap": "", "plus": "+", "dot": ".", "digit": DIGIT_WORDS.get(m[0].lower(), "")}[m.lastgroup]
            yield m.start(), m.end(), new


def _mixed_edits(text: str) -> Iterator[tuple[int, int, str]]:
    for run in MIXED.finditer(text):
        for m in DIGIT_WORD.finditer(text, run.start(), run.end()):
            yield *m.span(), DIGIT_WORDS[m[0].lower()]


def _dot_edits(text: str) -> Iterator[tuple[int, int, str]]:
    for run in WORDED_IP.finditer(text):
        for m in DOT_WORD.finditer(text, run.start(), run.end()):
            yield *m.span(), "."


def _at_edits(text: str) -> Iterator[tuple[int, int, str]]:
    for m in WORDED_AT.finditer(text):
        if m["name"].lower() not in BEFORE_AT:
            yield *m.span("at"), "@"


def _sign_edits(text: str) -> Iterator[tuple[int, int, str]]:
    for m in WORDED.finditer(text):
        if m["at"] != "@":
            yield *m.span("at"), "@"
        for dot in DOT_WORD.finditer(text, *m.span("dots")):
            yield *dot.span(), "."


def _bracket_edits(text: str) -> list[tuple[int, int, str]]:
    return sorted([(*m.span(), "@") for m in AT_BRACKETED.finditer(text)] + [(*m.span(), ".") for m in DOT_BRACKETED.finditer(text)])


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises, or None if it has none."""
    odd = set() if text.isascii() else {c for c in set(text) if plain(c) is not None}
    mixed = "+" in text and MIXED.search(text)
    if not odd and not mixed and not DISGUISED.search(text) and not SPELLED.search(text):
        return None
    out = Rewritten(text)
    if odd:
        out.apply((m.start(), m.end(), plain(m[0])) for m in re.finditer("[" + re.escape("".join(odd)) + "]", text))
    for edits in (_spelled_edits, _mixed_edits, _bracket_edits, _dot_edits, _sign_edits, _at_edits):
        out.apply(edits(out.text))
    return out


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    base = detect(text)
    clear = rewrite(text)
    if clear is None:
        return base, base
    added = []
    for kind, a, b in detect(clear.text):
        span = Span(kind, clear.low[a], clear.high[b - 1])
        known = any(s.kind == kind and s.start < span.end and span.start < s.end for s in base)
        if not known and any(clear.edited[a:b]):
            added.append(span)
    return base, ordered([*base, *added], KINDS)


def _find_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find(text or "") for text in batch.column("text").to_pylist()]
        counts = [pa.array([sum(s.kind == kind for s in base) for base, _ in found], pa.int64()) for kind in KINDS]
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), *counts, pa.array([digest(base) for base, _ in found], pa.string()),
            pa.array([joined(every) for _, every in found], pa.string()),
            *[pa.array([sum(s.kind == kind for s in every) for _, every in found], pa.int64()) for kind in KINDS],
        ], ["id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans", *[f"all_{kind}" for kind in KINDS]])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, all_email, ..., all_phone)``; no shuffle.

    The counts ``n_`` and the digest are of base spans; ``spans`` has all as ``kind:start:end``, and
    the counts ``all_`` are of these.
    """
    schema = ", ".join([
        "id long", *[f"n_{kind} long" for kind in KINDS], "base_sha256 string", "spans string", *[f"all_{kind} long" for kind in KINDS]])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_find_rows, schema)


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, done = [], 0
    for span in find(text)[1]:
        if span.start >= done:
            out += [text[done : span.start], f"[{span.kind}]"]
        done = max(done, span.end)
    return "".join([*out, text[done:]])
