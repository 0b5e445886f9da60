"""BPE encoding with content-defined chunk reuse.

A rolling hash over the last bytes ends a chunk wherever it hits a pattern, so equal passages are
cut alike in every document that holds them. A chunk found more than once is encoded once, and
its ids are sent to the documents that hold it; what no other document has is encoded in place.
Joins are then repaired: a chunk's first and last tokens depend on what lies beyond it, so from
either edge the join moves inward, from one safe place to the next, until a token of the chunk
begins exactly there, and everything between the places left is encoded anew. A place is safe if a
space stands between two ASCII letters: there every tokenizer that splits words before merging
begins a word, whatever the rest of the text.

Texts move once, compressed: they meet the chunks to encode and, later, the encoded ones, on one
shuffle. Only hashes are grouped, counted before they move. The places of a chunk that very many documents hold
are dealt to several tasks, each with the chunk's ids.

Vocabularies of the common byte-level form are applied by a library that encodes them several
times faster than the one that defines their file format, with equal ids; others, and texts that hold
a special token's name, by the latter.

Defined results: a null or empty text has no ids. Rows may repeat.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import workspace
from wardbook.llm.shingles import PIECE, POWERS, mix

#: Bytes that the rolling hash sees; one place in ``CHUNK_BYTES`` ends a chunk; the least chunk.
WINDOW = 24
CHUNK_BYTES = 1024
LEAST_CHUNK = 192
#: Chunks that have more than one of so many parts of all places are dealt to several tasks.
PLACE_PARTS = 1000

# Fixed value: where byte-level vocabularies split texts before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(path: str) -> str:
    """A tokenizer file's text. Read on the driver, so that executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _ends(raw: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last bytes hits the pattern."""
    if len(raw) <= WINDOW:
        return np.zeros(0, dtype=np.int64)
    up, down = POWERS.of(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=sums[1:])
    hashes = mix((sums[WINDOW:] - sums[:-WINDOW]) * down[: len(raw) + 1 - WINDOW])
    return np.flatnonzero(hashes % np.uint64(CHUNK_BYTES) == 0) + WINDOW


def chunk_bounds(data: bytes) -> list[int]:
    """Byte offsets that cut ``data`` into chunks, 0 and its length included.

    A cut never splits a character. Long texts are hashed piece by piece, each with the bytes
    before it that the window needs.
    """
    bounds, raw = [0], np.frombuffer(data, dtype=np.uint8)
    for low in range(0, len(raw), PIECE):
        start = max(0, low - WINDOW + 1)
        for end in (_ends(raw[start : low + PIECE]) + start).tolist():
            if end < len(raw) and end - bounds[-1] >= LEAST_CHUNK and raw[end] & 0xC0 != 0x80:
                bounds.append(end)
    return [*bounds, len(raw)] if len(raw) else [0]


def _letter(byte: int) -> bool:
    return 65 <= byte <= 90 or 97 <= byte <= 122


def _safe(data: bytes, at: int) -> bool:
    return 0 < at < len(data) - 1 and data[at] == 32 and _letter(data[at - 1]) and _letter(data[at + 1])


def _joined(values: pa.Array, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """The values of all ids in one buffer, and where each begins; the last entry is the buffer's end."""
    taken = values.take(pa.array(ids))
    _, offsets, data = taken.buffers()
    return np.frombuffer(offsets, dtype=np.int32)[: len(ids) + 1], memoryview(data if data is not None else b"")


class Coder:
    """A byte-level BPE tokenizer and the bytes of its tokens."""

    def __init__(self, text: str):
        file = json.loads(text)
        # Byte-level alphabets write printable bytes as themselves and the others from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ids = {**((file.get("model") or {}).get("vocab") or {}), **{t["content"]: t["id"] for t in file.get("added_tokens") or []}}
        own = [b""] * (max(ids.values(), default=-1) + 1)
        for token, i in ids.items():
            own[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self.bytes = pa.array(own, pa.binary())
        self.lengths = np.array([len(b) for b in own], dtype=np.int64)
        self.names = pa.array([f"{i}," for i in range(len(own))], pa.string())
        #: How ids travel.
        self.kind = np.uint16 if len(own) <= 1 << 16 else np.int32
        self.fast, self.special = self._plain_form(file, byte_of)
        self._text = text

    @cached_property
    def tokenizer(self):
        """The library that defines the file format; loaded when a text needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self._text)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @staticmethod
    def _plain_form(file: dict, byte_of: dict[str, int]) -> tuple[object | None, list[str]]:
        """An equal, faster encoder for vocabularies whose ids follow the order of merges, and special tokens."""
        model, before = file.get("model") or {}, file.get("pre_tokenizer") or {}
        vocab, special = model.get("vocab") or {}, [t["content"] for t in file.get("added_tokens") or []]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model.get("merges") or []]
        ids = [vocab.get(m, -1) for m in merged]
        plain = (
            model.get("type") == "BPE" and not file.get("normalizer") and not file.get("post_processor")
            and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and ids == sorted(set(ids)) and ids[:1] > [255] and set(byte_of) <= set(vocab) and max(vocab[c] for c in byte_of) < 256
        )
        if not plain:
            return None, special
        import tiktoken

        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("from-file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}), special

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        slow = [self.fast is None or any(name in t for name in self.special) for t in texts]
        left = [t for t, s in zip(texts, slow) if s]
        found = iter(self.tokenizer.encode_batch_fast(left, add_special_tokens=False) if left else [])
        return [
            np.array(next(found).ids, dtype=self.kind) if s
            else self.fast.encode_to_numpy(t, disallowed_special=()).astype(self.kind)
            for t, s in zip(texts, slow)
        ]

    def decode(self, ids: np.ndarray) -> str:
        return bytes(_joined(self.bytes, np.asarray(ids, dtype=self.kind))[1]).decode("utf-8", "replace")

    def digests(self, found: list[np.ndarray]) -> tuple[list[str], list[str]]:
        """Per text the hash of its ids in decimal, joined by commas, and of what they decode to."""
        flat = np.concatenate([*found, np.zeros(0, dtype=self.kind)])
        ends = np.cumsum([0] + [len(ids) for ids in found])
        at, names = _joined(self.names, flat)
        lists = [hashlib.sha256(names[at[a] : max(at[a], at[b] - 1)]).hexdigest() for a, b in zip(ends, ends[1:])]
        at, data = _joined(self.bytes, flat)
        decoded = [bytes(data[at[a] : at[b]]).decode("utf-8", "replace").encode() for a, b in zip(ends, ends[1:])]
        return lists, [hashlib.sha256(d).hexdigest() for d in decoded]

    def core(self, chunk: bytes, ids: np.ndarray) -> tuple[int, int, np.ndarray]:
        """The part of a chunk whose ids hold in any text, as byte offsets, and these ids."""
        begins = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        if begins[-1] != len(chunk):
            return 0, 0, np.zeros(0, dtype=self.kind)
        agreed = set(begins.tolist())
        low, high = 1, len(chunk) - 2
        while low < high and not (_safe(chunk, low) and low in agreed):
            low += 1
        while high > low and not (_safe(chunk, high) and high in agreed):
            high -= 1
        if low >= high:
            return 0, 0, np.zeros(0, dtype=self.kind)
        i, j = np.searchsorted(begins, [low, high])
        return low, high, ids[i:j]


@lru_cache(maxsize=2)
def _coder(text: str) -> Coder:
    return Coder(text)


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, which shuffles write as they are."""
    compressor = zstandard.ZstdCompressor()
    for batch in batches:
        packed = [compressor.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("id", "r1", "r2")), pa.array(packed, pa.binary())], ["id", "r1", "r2", "packed"]
        )


def _unpacked(column: pa.Array) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(p) for p in column.to_pylist()]


CHUNKS = "r1 long, r2 long, at long, size long, h binary"


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, ats, sizes, hashes = [], [], [], []
        for row, text in enumerate(batch.column("text").to_pylist()):
            data = (text or "").encode()
            bounds = chunk_bounds(data)
            for low, high in zip(bounds, bounds[1:]):
                rows.append(row)
                ats.append(low)
                sizes.append(high - low)
                hashes.append(hashlib.blake2b(data[low:high], digest_size=16).digest())
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column("r1").take(take), batch.column("r2").take(take), pa.array(ats, pa.int64()),
            pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()),
        ], ["r1", "r2", "at", "size", "h"])


CORES = "h binary, low long, high long, ids binary"


def _core_rows(vocabulary_text):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary_text.value)
        for batch in batches:
            out = []
            for data, chunks in zip(_unpacked(batch.column("packed")), batch.column("chunks").to_pylist()):
                pieces = [data[c["at"] : c["at"] + c["size"]] for c in chunks]
                for chunk, piece, ids in zip(chunks, pieces, coder.encode([p.decode() for p in pieces])):
                    low, high, core = coder.core(piece, ids)
                    out.append((chunk["h"], low, high, core.tobytes()))
            columns = zip(*out) if out else ([], [], [], [])
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["h", "low", "high", "ids"])

    return run


def assemble(coder: Coder, texts: list[str], parts: list[list[dict]]) -> list[np.ndarray]:
    """Ids of each text: its chunks' cores, and what lies between them encoded here, as one batch."""
    plans, gaps = [], []
    for text, cores in zip(texts, parts):
        data, plan, done = text.encode(), [], 0
        for core in sorted(cores, key=lambda c: c["at"]):
            if core["at"] + core["low"] < done:
                continue  # the same chunk again, from a repeated row
            low, high = core["at"] + core["low"], core["at"] + core["high"]
            if low > done:
                plan.append(len(gaps))
                gaps.append(data[done:low].decode())
            plan.append(core["ids"])
            done = high
        if done < len(data):
            plan.append(len(gaps))
            gaps.append(data[done:].decode())
        plans.append(plan)
    encoded = coder.encode(gaps)
    none = np.zeros(0, dtype=coder.kind)
    return [
        np.concatenate([none, *(encoded[step] if isinstance(step, int) else np.frombuffer(step, dtype=coder.kind) for step in plan)])
        for plan in plans
    ]


def _encoded_rows(vocabulary_text, emit_ids: bool, batch_chars: int = 1 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from wardbook.llm.shingles import slices

        coder = _coder(vocabulary_text.value)
        for batch in batches:
            texts = [data.decode() for data in _unpacked(batch.column("packed"))]
            parts = [p or [] for p in batch.column("parts").to_pylist()]
            for part in slices(texts, batch_chars):
                found = assemble(coder, texts[part], parts[part])
                lists, decoded = coder.digests(found)
                columns = [
                    batch.column("id").slice(part.start, len(found)),
                    pa.array([len(ids) for ids in found], pa.int64()),
                    pa.array(lists, pa.string()), pa.array(decoded, pa.string()),
                ]
                labels = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if emit_ids:
                    columns.append(pa.array([ids.astype(np.int32) for ids in found], pa.list_(pa.int32())))
                    labels.append("ids")
                yield pa.RecordBatch.from_arrays(columns, labels)

    return run


def encode(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per row ``(id, n_tokens, ids_sha256, decoded_sha256)``, and ``ids`` if asked for."""
    spark = docs.sparkSession
    work = workspace(spark)
    text = spark.sparkContext.broadcast(vocabulary(vocabulary_path))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
        F.xxhash64(F.lit(1), id_col, text_col).alias("r1"), F.xxhash64(F.lit(2), text_col, id_col).alias("r2"),
    )
    # Both joins below see the same rows: without the filter only one of them would drop null keys.
    packed = rows.mapInArrow(_pack_rows, "id long, r1 long, r2 long, packed binary").filter("r1 IS NOT NULL AND r2 IS NOT NULL")
    chunks = work.keep(rows.select("r1", "r2", "text").mapInArrow(_chunk_rows, CHUNKS), "chunks")
    place = F.struct("r1", "r2", "at", "size")
    shared = work.keep(
        chunks.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1"), "shared"
    )
    firsts = (
        shared.select("h", "first.*").groupBy("r1", "r2")
        .agg(F.collect_list(F.struct("at", "size", "h")).alias("chunks"))
    )
    cores = (
        packed.join(firsts.hint("shuffle_hash"), ["r1", "r2"]).mapInArrow(_core_rows(text), CORES)
        .dropDuplicates(["h"]).filter("high > low")
    )
    # A chunk's places move, not its text. Of the chunks whose places are dealt to several tasks there are few.
    share = math.ceil(chunks.count() / PLACE_PARTS)
    common = F.broadcast(shared.filter(F.col("n") > share).select("h", F.ceil(F.col("n") / share).cast("int").alias("tasks")))
    tasks = F.coalesce("tasks", F.lit(1))
    places = chunks.join(common, "h", "left").select(
        "r1", "r2", "at", "h", F.pmod(F.xxhash64("r1", "at"), tasks).cast("int").alias("task"))
    dealt = cores.join(common, "h", "left").select(
        "h", "low", "high", "ids", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("task"))
    parts = (
        places.join(dealt, ["h", "task"]).groupBy("r1", "r2")
        .agg(F.collect_list(F.struct("at", "low", "high", "ids")).alias("parts"))
    )
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return (
        packed.join(parts.hint("shuffle_hash"), ["r1", "r2"], "left").select("id", "packed", "parts")
        .mapInArrow(_encoded_rows(text, with_ids), schema)
    )


def decode(encoded: DataFrame, vocabulary_path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``(id, text)`` from ids, special tokens included; null ids give a null text."""
    text = encoded.sparkSession.sparkContext.broadcast(vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(text.value)
        for batch in batches:
            found = [None if ids is None else coder.decode(np.array(ids, dtype=np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], ["id", "text"])

    return encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, "id long, text string")
