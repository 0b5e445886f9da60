"""Big JSON documents, each read by many tasks.

A document ``{..., "field": [{...}, {...}, ...], ...}`` is read as text cut at every opening brace, so
its file splits over tasks wherever Spark cuts it, whatever the white space between records. In the
plain layout every piece is then a record, and a task parses its own without meeting any other. One
pass over the text says whether all files have that layout: a record's piece begins with the name of one
of its fields, which text in a string cannot, as the quotes in it are escaped.

Otherwise, as when strings hold braces, records hold objects, or a file holds several documents,
pieces are put together again. Whether a place is in a string, how deep it is nested, and which
array it is in follow from the text before it, so a task that walks over a block of a file from its start
knows where records begin and end. Only blocks of files that Spark cuts start in the middle: a first pass
sums up each of these, for a start in a string and for one outside, in one row, and the driver chains the
rows of a file. Records that lie in one block are written as they are found, without a shuffle; of a
record across blocks the parts, at most two a block, are put together.

Results equal those of the document reader for valid documents, except that null elements of the
array are left out. A document without records gives one row without any. Of a document that breaks off the whole
records are read.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from wardbook.sources.tables import Workspace, query_workspace

# Executors get the walk's code with the task and need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The characters that structure JSON, and how each changes the depth.
QUOTE, BACKSLASH, BRACKET, BRACE = b'"\\[{'
SIGNS = np.zeros(256, bool)
SIGNS[list(b'"\\[]{}')] = True
STEPS = np.zeros(256, np.int64)
STEPS[list(b"[{")] = 1
STEPS[list(b"]}")] = -1

#: How an array of the wanted field is noted among what is open; others are noted by their brace or bracket.
FIELD = ord("f")

#: Documents nested deeper are not JSON to Spark's reader.
DEEPEST = 1000

#: Pieces looked at before all are, as one that is nothing of the plain layout is mostly among the first.
PEEK = 1000


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, cut, n, piece)``: the text between opening braces, ``n`` rising within a block of a file.

    ``cut``: the file has other blocks.
    """
    return spark.read.option("lineSep", "{").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (F.col("_metadata.file_block_length") < F.col("_metadata.file_size")).alias("cut"),
        F.monotonically_increasing_id().alias("n"), F.col("value").alias("piece"),
    )


def _opens(field: str) -> Column:
    return F.col("piece").rlike(rf'"{field}"\s*:\s*\[\s*$')


def _is_plain(pieces: DataFrame, field: str, names: Sequence[str]) -> bool:
    """Whether each file is blank up to its first brace, then the envelope, then records up to the array's end."""
    at = F.struct("block", "n")
    starts = rf'^\s*"(?:{"|".join(names)})"\s*:'
    kind = (
        F.when(_opens(field), "envelope").when(F.col("piece").rlike(starts), "record")
        .when(F.col("piece").rlike(r"^\s*$"), "blank").otherwise("other")
    )
    kinds = pieces.withColumn("kind", kind)
    if not kinds.limit(PEEK).filter("kind = 'other'").isEmpty():
        return False
    closing = F.col("kind").eqNullSafe("record") & F.col("piece").rlike(r"\}\s*\]")

    def of(wanted: str) -> Column:
        return F.when(F.col("kind") == wanted, at)

    files = kinds.groupBy("file").agg(
        F.count_if(F.col("kind") == "other").alias("others"), F.count(of("blank")).alias("blanks"),
        F.count(of("envelope")).alias("envelopes"), F.count_if(closing).alias("ends"),
        F.min(at).alias("first"), F.min(of("blank")).alias("blank"), F.min(of("envelope")).alias("envelope"),
        F.min(of("record")).alias("low"), F.max(of("record")).alias("high"), F.max(F.when(closing, at)).alias("end"),
    )
    plain = (
        (F.col("others") == 0) & (F.col("blanks") == 1) & (F.col("envelopes") == 1) & (F.col("ends") == 1)
        & (F.col("first") == F.col("blank")) & (F.col("envelope") < F.col("low")) & (F.col("end") == F.col("high"))
    )
    return files.filter(~F.coalesce(plain, F.lit(False))).isEmpty()


def _signs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where quotes, brackets and braces are, and what each is; without quotes that a backslash escapes."""
    at = np.flatnonzero(SIGNS.take(text))
    sign = text[at]
    kept = sign != BACKSLASH
    slash = np.flatnonzero(~kept)
    if not len(slash):
        return at, sign
    # Every other backslash of a run escapes what follows it.
    index, where = np.arange(len(slash)), at[slash]
    first = np.ones(len(slash), bool)
    first[1:] = np.diff(where) != 1
    escapes = (index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0
    next_one = slash[escapes] + 1
    there = next_one < len(at)
    next_one, where = next_one[there], where[escapes][there]
    kept[next_one[at[next_one] == where + 1]] = False
    return at[kept], sign[kept]


def _outside(sign: np.ndarray, inside: int) -> tuple[np.ndarray, int]:
    """Which signs are brackets and braces outside strings, if the first is ``inside`` one or not, and where the last leaves."""
    quotes = sign == QUOTE
    sides = (np.cumsum(quotes, dtype=np.uint8) + np.uint8(inside)) & 1
    return np.flatnonzero(~quotes & (sides == 0)), int(sides[-1]) if len(sides) else inside


def _opens_field(text: np.ndarray, at: np.ndarray, sign: np.ndarray, i: int, field: bytes) -> bool:
    """Whether sign ``i`` is a bracket after the name of the field."""
    if i < 2 or sign[i] != BRACKET or sign[i - 1] != QUOTE or sign[i - 2] != QUOTE:
        return False
    name, colon = text[at[i - 2] + 1 : at[i - 1]], text[at[i - 1] + 1 : at[i]]
    return name.tobytes() == field and colon.tobytes().strip() == b":"


class _Sum:
    """What a stretch of text does to the depth, whatever it was before: ``net`` of it, the lowest (``low``) it comes to,
    and what it leaves ``open``, a byte for each level above the lowest."""

    def __init__(self, inside: int):
        self.inside, self.net, self.low, self.open = inside, 0, 0, bytearray()

    def add(self, text: np.ndarray, at: np.ndarray, sign: np.ndarray, field: bytes) -> None:
        out, self.inside = _outside(sign, self.inside)
        if not len(out):
            return
        step = STEPS[sign[out]]
        after = np.cumsum(step)
        low = min(0, int(after.min()))
        left = out[(step == 1) & (np.minimum.accumulate(after[::-1])[::-1] == after)]
        kinds = sign[left]
        for k in np.flatnonzero(kinds == BRACKET):
            if _opens_field(text, at, sign, left[k], field):
                kinds[k] = FIELD
        del self.open[max(0, self.net + low - self.low):]
        self.open += kinds.tobytes()
        self.low = min(self.low, self.net + low)
        self.net += int(after[-1])

    def row(self) -> dict:
        """Of what is open the levels that can matter at the start of the next block."""
        lowest = max(self.low, -DEEPEST)
        return {"net": self.net, "low": self.low, "open": bytes(self.open[lowest - self.low : DEEPEST - self.low])}


#: Bytes of the key before a piece. Its last is ``CUT`` if the file has other blocks.
KEY, CUT = 17, b"+"


def _rows(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``row``: the key of its block, and the piece behind its brace.

    Arrow takes as long for a column as for the text, so the key is not one.
    """
    key = F.lpad(F.hex(F.xxhash64("file", "block")), KEY - 1, "0")
    cut = F.when(F.col("cut"), F.lit(CUT.decode())).otherwise(F.lit("-"))
    return pieces.withColumn("row", F.concat(key, cut, F.lit("{"), F.col("piece")))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Per run of rows of one block its first row, the block's key and its text."""
    rows = batch.column("row")
    if not len(rows):
        return
    wide = np.int64 if pa.types.is_large_string(rows.type) else np.int32
    _, offsets, data = rows.buffers()
    ends = np.frombuffer(offsets, wide)[rows.offset : rows.offset + len(rows) + 1].astype(np.int64)
    data, ends = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]
    head = ends[:-1, None] + np.arange(KEY)
    key = data[head].view(f"S{KEY}").ravel()
    is_text = np.ones(len(data), bool)
    is_text[head.ravel()] = False
    text, ends = data[is_text], ends - KEY * np.arange(len(ends))
    bounds = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)]
    for low, high in zip(bounds, bounds[1:]):
        yield int(low), bytes(key[low]), text[ends[low] : ends[high]]


SUM = "struct<net long, low long, open binary>"


def _sum_rows(field: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("key", pa.binary()), ("file", pa.string()), ("block", pa.int64()), ("quotes", pa.int64()),
            *[(name, pa.struct([("net", pa.int64()), ("low", pa.int64()), ("open", pa.binary())])) for name in ("outside", "within")],
        ])
        key, place, sums = None, (None, None), ()

        def row() -> pa.RecordBatch:
            outside, within = sums
            values = {
                "key": key, "file": place[0], "block": place[1], "quotes": outside.inside, "outside": outside.row(),
                "within": within.row(),
            }
            return pa.RecordBatch.from_pylist([values], schema)

        for batch in batches:
            for first, at_key, text in _runs(batch):
                if at_key != key:
                    if sums:
                        yield row()
                    key, sums = at_key, (_Sum(0), _Sum(1))
                    place = batch.column("file")[first].as_py(), batch.column("block")[first].as_py()
                    if place[1] == 0:
                        text = text[1:]
                at, sign = _signs(text)
                for s in sums:
                    s.add(text, at, sign, field)
        if sums:
            yield row()

    return run


#: Where a block is and what holds at its start: file, block, if it starts in a string, how deep, in the field's array, in a record of it.
Start = tuple[str, int, int, int, bool, bool]


def _starts(sums: Sequence[Row]) -> dict[bytes, Start]:
    """What holds at the start of each block, by key."""
    starts = {}
    for file, blocks in groupby(sorted(sums, key=lambda r: (r["file"], r["block"])), key=lambda r: r["file"]):
        inside, depth, kinds = 0, 0, {2: None, 3: None}
        for block in blocks:
            listed = kinds[2] == FIELD
            starts[bytes(block["key"])] = file, block["block"], inside, depth, listed, listed and kinds[3] == BRACE
            taken = block["within" if inside else "outside"]
            lowest = max(taken["low"], -DEEPEST)
            for level in kinds:
                at = level - depth
                if at > taken["low"]:
                    kinds[level] = taken["open"][at - lowest - 1] if 0 < at - lowest <= len(taken["open"]) else None
            inside, depth = (inside + block["quotes"]) % 2, depth + taken["net"]
    if len(starts) < len(sums):
        raise ValueError("two blocks have the same key")
    return starts


def _strings(kind: pa.DataType, data, bounds: Sequence[int] | np.ndarray) -> pa.Array:
    wide = np.int64 if pa.types.is_large_string(kind) else np.int32
    offsets = np.ascontiguousarray(bounds, wide)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _joined(kind: pa.DataType, values: Sequence[bytes]) -> pa.Array:
    return _strings(kind, b"".join(values), np.cumsum([0, *map(len, values)]))


class _Walk:
    """A walk over a block from what holds at its start.

    ``records`` are those of the document it is in, ``docs`` the documents that begin in the block, and
    ``before`` the records before the first of them. Documents that begin and end in the block without a record are ``bare``.
    """

    def __init__(self, inside: int = 0, depth: int = 0, listed: bool = False, taking: bool = False):
        self.inside, self.depth, self.listed, self.taking = inside, depth, listed, taking
        self.own, self.kept = not taking, []
        self.docs = self.records = self.before = self.bare = 0
        self.whole: list[pa.Array] = []
        self.parts: list[tuple[bool, bytes]] = []

    def over(self, text: np.ndarray, field: bytes, kind: pa.DataType) -> None:
        at, sign = _signs(text)
        out, self.inside = _outside(sign, self.inside)
        sign_out, where = sign[out], at[out]
        step = STEPS[sign_out]
        after = self.depth + np.cumsum(step)
        lists = np.flatnonzero((step == 1) & (after == 2))
        listed = np.array([self.listed, *[_opens_field(text, at, sign, i, field) for i in out[lists]]])
        braces = sign_out == BRACE
        begins = np.flatnonzero(braces & (after == 3))
        begins = begins[listed[np.searchsorted(lists, begins)]]
        ends = np.flatnonzero((step == -1) & (after == 2))
        self._count(np.searchsorted(begins, np.flatnonzero(braces & (after == 1))), len(begins))
        if self.taking:
            if len(ends):
                self._close(text[: where[ends[0]] + 1], kind)
            else:
                self.kept.append(text.tobytes())
        closed = np.searchsorted(ends, begins)
        full = closed < len(ends)
        if full.any():
            # Records and what lies between them in turn, of which the records are taken.
            bounds = np.stack([where[begins[full]], where[ends[closed[full]]] + 1], axis=1).ravel()
            self.whole.append(_strings(kind, text, bounds).take(pa.array(np.arange(0, len(bounds), 2))))
        if len(begins) and not full[-1]:
            self.taking, self.own, self.kept = True, True, [text[where[begins[-1]] :].tobytes()]
        self.listed = bool(listed[-1])
        self.depth = int(after[-1]) if len(after) else self.depth

    def _count(self, firsts: np.ndarray, n: int) -> None:
        """``firsts``: how many of the ``n`` records lie before each document that begins."""
        counts = np.diff([0, *firsts, n])
        counts[0] += self.records
        if len(firsts):
            closed = counts[:-1]
            if not self.docs:
                self.before, closed = int(closed[0]), closed[1:]
            self.bare += int(np.count_nonzero(closed == 0))
            self.docs += len(firsts)
        self.records = int(counts[-1])

    def _close(self, rest: np.ndarray, kind: pa.DataType) -> None:
        text = b"".join([*self.kept, rest.tobytes()])
        if self.own:
            self.whole.append(_joined(kind, [text]))
        else:
            self.parts.append((False, text))
        self.taking, self.own, self.kept = False, True, []

    def end(self, cut: bool, kind: pa.DataType) -> None:
        """At the end of the block, which is the file's unless it is ``cut``."""
        if self.taking and cut:
            self.parts.append((self.own, b"".join(self.kept)))
        elif self.taking:
            self.whole.append(_joined(kind, [b"".join(self.kept)]))
        if not cut and self.records == 0:
            self.bare += 1


FOUND = "file string, block long, begins boolean, part string, doc long, records long, piece string"


def _found_rows(field: bytes, starts: dict[bytes, Start]):
    """Whole records, and a row without any for each document that has none, by themselves; of cut files also the parts
    of records across blocks, and the records of the documents that the block did not begin or may not end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, place, walk, kind = None, None, None, pa.string()

        def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
            kinds = {
                "file": kind, "block": pa.int64(), "begins": pa.bool_(), "part": kind, "doc": pa.int64(), "records": pa.int64(),
                "piece": kind,
            }
            return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, t)) for c, t in kinds.items()], names=list(kinds))

        def found() -> list[pa.Array]:
            some = [*walk.whole, *([pa.nulls(walk.bare, kind)] if walk.bare else [])]
            walk.whole, walk.bare = [], 0
            return some

        def edges() -> Iterator[pa.RecordBatch]:
            file, block = place

            def of(n: int, **columns: pa.Array) -> pa.RecordBatch:
                return rows(n, file=_joined(kind, [file.encode()] * n), block=pa.array([block] * n, pa.int64()), **columns)

            if walk.parts:
                begins, parts = zip(*walk.parts)
                yield of(len(parts), begins=pa.array(begins, pa.bool_()), part=_joined(kind, parts))
            counts = [(0, walk.before), (walk.docs, walk.records)] if walk.docs else [(0, walk.records)]
            docs, records = (pa.array(c, pa.int64()) for c in zip(*counts))
            yield of(len(counts), doc=docs, records=records)

        for batch in batches:
            kind, pieces = batch.column("row").type, []
            for _, at_key, text in _runs(batch):
                if at_key != key:
                    if walk is not None:
                        walk.end(place is not None, kind)
                        pieces += found()
                        if place is not None:
                            yield from edges()
                    start = starts[at_key] if at_key.endswith(CUT) else ()
                    key, place, walk = at_key, start[:2] or None, _Walk(*start[2:])
                    if place is None or place[1] == 0:
                        text = text[1:]
                walk.over(text, field, kind)
                pieces += found()
            if pieces:
                whole = pa.concat_arrays(pieces)
                yield rows(len(whole), piece=whole)
        if walk is not None:
            walk.end(place is not None, kind)
            if pieces := found():
                whole = pa.concat_arrays(pieces)
                yield rows(len(whole), piece=whole)
            if place is not None:
                yield from edges()

    return run


def _reassembled(pieces: DataFrame, field: str, work: Workspace) -> DataFrame:
    """Texts of the records, and a null for every document and file that has none."""
    rows = _rows(pieces)
    sums = rows.filter("cut").select("row", "file", "block").mapInArrow(
        _sum_rows(field.encode()), f"key binary, file string, block long, quotes long, outside {SUM}, within {SUM}").collect()
    found = work.keep(rows.select("row").mapInArrow(_found_rows(field.encode(), _starts(sums)), FOUND), f"records-{uuid.uuid4().hex}")
    whole = found.filter("file IS NULL").select("piece")
    if not sums:
        return whole

    # A part that begins no record belongs to the last record that an earlier block has begun.
    through = Window.partitionBy("file").orderBy("block", "begins").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    home = F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(through)
    across = (
        found.filter("part IS NOT NULL").withColumn("home", home).groupBy("file", "home")
        .agg(F.sort_array(F.collect_list(F.struct("block", "begins", "part"))).alias("parts"))
        .select(F.array_join("parts.part", "").alias("piece"))
    )
    earlier = Window.partitionBy("file").orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    documents = (
        found.filter("records IS NOT NULL").withColumn("doc", F.col("doc") + F.coalesce(F.sum("doc").over(earlier), F.lit(0)))
        .groupBy("file", "doc").agg(F.sum("records").alias("records"))
    )
    files = documents.groupBy("file").agg(F.max("doc").alias("docs"))
    bare = documents.join(files, "file").filter("records = 0 AND (doc > 0 OR docs = 0)")
    return whole.unionByName(across).unionByName(bare.select(F.lit(None).cast("string").alias("piece")))


def read_split_documents(
    spark: SparkSession, path: str, field: str, names: Sequence[str], record_schema: str, work: Workspace | None = None
) -> DataFrame:
    """Rows with ``field`` as an array of one record each, so that flattening is that of documents.

    ``work`` holds the records of files that are not in the plain layout; by default it is the session's.
    """
    pieces = _pieces(spark, path)
    if _is_plain(pieces, field, names):
        texts = pieces.filter(~_opens(field) & ~F.col("piece").rlike(r"^\s*$")).select(F.concat(F.lit("{"), "piece").alias("piece"))
        return texts.select(F.array(F.from_json("piece", record_schema)).alias(field))
    texts = _reassembled(pieces, field, work or query_workspace(spark))
    return texts.select(F.when(F.col("piece").isNotNull(), F.array(F.from_json("piece", record_schema))).alias(field))
