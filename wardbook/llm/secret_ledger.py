"""Secret scans with an incremental ledger of blobs.

A version of a file is known by the SHA-256 of its content, its blob. The ledger holds, per blob
and rule version, what a scan found. A run scans only pairs that the ledger lacks, one text per
blob however many paths and versions carry it, appends its findings, and joins the ledger back
to all paths. A new rule version scans everything once more and leaves older findings in place.

Defined results: a null text is an empty one. Failing matches are dropped and not tried again
from their middle. A row without path keeps its findings. Rows may repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardbook.llm.spans import Span, ordered
from wardbook.operators.resolve import HeavyKeys, resolve

# The base kinds and patterns, with their least lengths.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
# Further kinds, by the prefixes their issuers publish.
EXTRA = {
    "pem": ("-----BEGIN", re.compile(r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----")),
    "jwt": ("eyJ", re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "forge": ("gh", re.compile(r"(?<![A-Za-z0-9])gh[opsur]_[A-Za-z0-9]{36,}")),
    "chat": ("xox", re.compile(r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{20,}")),
}
KINDS = (*BASE_KINDS, *EXTRA)

#: Blobs that have more than one of so many parts of all rows count as heavy; there are fewer than so many.
PATH_PARTS = 500

#: Changes with the rules, so that blobs scanned under older ones are scanned again.
RULE_VERSION = 1

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rule_version int, findings {FINDINGS}"


def scan(text: str) -> list[Span]:
    """All findings in one text. A substring test comes before each pattern."""
    found, lower = [], text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [Span("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [Span("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [Span("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for kind, (prefix, pattern) in EXTRA.items():
        if prefix in text:
            found += [Span(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return ordered(found, KINDS)


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    last = None
    for batch in batches:
        blobs, found = [], []
        for blob, text in zip(batch.column("blob").to_pylist(), batch.column("text").to_pylist()):
            if blob != last:  # rows that repeat both blob and path lie side by side
                blobs.append(blob)
                found.append([s._asdict() for s in scan(text or "")])
            last = blob
        yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.string()), pa.array(found, kind)], ["blob", "findings"])


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


class BlobLedger:
    """Findings per blob and rule version in a Parquet folder on shared storage."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def known(self, version: int) -> DataFrame:
        return self.table().filter(F.col("rule_version") == version)

    def update(self, versions: DataFrame, path_col: str, text_col: str, rule_version: int = RULE_VERSION) -> None:
        """Scan what the ledger lacks, and append it. A run that is cut off appends nothing.

        Of each unseen blob one path is read: the choice needs no texts, so texts move once, to
        meet it, and only unseen ones go on to the scan.
        """
        rows = versions.select(
            blob_of(F.col(text_col)).alias("blob"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("at"),
            F.col(text_col).alias("text"),
        )
        unseen = (
            rows.groupBy("blob").agg(F.min("at").alias("at"))
            .join(self.known(rule_version).select("blob"), "blob", "left_anti")
        )
        scanned = (
            rows.join(unseen.hint("shuffle_hash"), ["blob", "at"], "left_semi")
            .select("blob", "text").mapInArrow(_scan_rows, f"blob string, findings {FINDINGS}")
        )
        scanned.select("blob", F.lit(rule_version).alias("rule_version"), "findings").write.mode("append").parquet(self.path)

    def findings(self, versions: DataFrame, path_col: str, text_col: str, rule_version: int = RULE_VERSION) -> DataFrame:
        """``(path, findings)`` per row of ``versions``; null findings for blobs never scanned.

        Paths of a blob that holds over a part in ``PATH_PARTS`` of all rows are dealt to several tasks.
        """
        once = self.known(rule_version).groupBy("blob").agg(F.min("findings").alias("findings"))
        rows = versions.select(F.col(path_col).alias("path"), blob_of(F.col(text_col)).alias("blob"))
        heavy = HeavyKeys(max(1, versions.count() // PATH_PARTS), PATH_PARTS)
        return resolve(rows, once, ["blob"], spread=["path"], heavy=heavy).select("path", "findings")
