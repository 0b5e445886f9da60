"""Embedding near-dedup by random-hyperplane sign hashing.

Equal vectors form a class, and one of them stands for it. In each of several tables a vector's
bucket is the sign pattern of its products with random hyperplanes, so that vectors at a small
angle often share one. Within a bucket all cosines are computed in double precision; a bucket of
more than ``block`` vectors is cut into blocks, and each pair of blocks is a task of its own.
Blocks return, per vector, how many links it has and one link towards its component: never the
pairs themselves. A pair that meets in several tables counts in the first.

Buckets keep their size as the input grows: the number of hyperplanes follows the number of
vectors, and the number of tables follows from the wanted recall at the threshold.

Defined results: a vector that is null, empty or zero, or has a null or non-finite component,
links with nothing; vectors of different lengths do not link. A row without id has no links and
a null component, and is kept. Rows that agree in id and vector are one vector; an id with several
vectors counts the links of each and is one node.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import workspace
from wardbook.llm.components import components


@dataclass(frozen=True)
class Settings:
    """``recall`` is the least probability that a pair at the threshold shares a bucket."""

    threshold: float = 0.9
    recall: float = 0.9995
    bucket_size: int = 64
    block: int = 2048
    seed: int = 6

    def tables(self, n: int) -> tuple[int, int]:
        """Hyperplanes a table and tables for ``n`` vectors."""
        planes = max(6, math.ceil(math.log2(max(2, n) / self.bucket_size)))
        alike = (1 - math.acos(self.threshold) / math.pi) ** planes
        return planes, math.ceil(math.log(1 - self.recall) / math.log(1 - alike))


def hyperplanes(dim: int, n: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((n, dim))


def _describe(planes: int, tables: int, seed: int):
    weights = 1 << np.arange(planes, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normals: dict[int, np.ndarray] = {}
        for batch in batches:
            column = batch.column("vector")
            kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
            digests, payloads, buckets, dims = [], [], [], []
            for value in column:
                raw = None
                if value.is_valid and not value.values.null_count:
                    raw = value.values.to_numpy(zero_copy_only=False).astype(kind)
                if raw is None or not len(raw) or not np.isfinite(raw).all() or not raw.any():
                    for out in (digests, payloads, buckets, dims):
                        out.append(None)
                    continue
                dim = len(raw)
                if dim not in normals:
                    normals[dim] = hyperplanes(dim, planes * tables, seed)
                exact = raw.astype(np.float64)
                signs = normals[dim] @ (exact / np.abs(exact).max()) >= 0
                digests.append(hashlib.blake2b(raw.tobytes(), digest_size=16).digest())
                payloads.append(raw.tobytes())
                buckets.append(signs.reshape(tables, planes) @ weights)
                dims.append(dim)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(digests, pa.binary()), pa.array(payloads, pa.binary()),
                pa.array(buckets, pa.list_(pa.int64())), pa.array(dims, pa.int32()),
            ], ["id", "digest", "payload", "buckets", "dim"])

    return run


def unit_rows(payloads: list[bytes], dim: int) -> np.ndarray:
    """Vectors of length one in double precision, whatever their scale."""
    kind = np.float32 if len(payloads[0]) == 4 * dim else np.float64
    rows = np.frombuffer(b"".join(payloads), dtype=kind).reshape(-1, dim).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _tile_links(threshold: float, strip: int = 128):
    def run(tile: pa.Table) -> pa.Table:
        nodes, copies = tile["node"].to_numpy(), tile["copies"].to_numpy()
        side, table = tile["side"].to_numpy(), tile["table"][0].as_py()
        units = unit_rows(tile["payload"].to_pylist(), tile["dim"][0].as_py())
        buckets = np.array(tile["buckets"].to_pylist(), dtype=np.int64)
        crossing = side.any() and not side.all()
        links, root = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
        for low in range(0, len(nodes), strip):
            near = units[low : low + strip] @ units.T >= threshold
            a, b = np.nonzero(near)
            a += low
            once = (a < b) & (nodes[a] != nodes[b])
            if crossing:
                once &= side[a] != side[b]
            a, b = a[once], b[once]
            first = (buckets[a] == buckets[b]).argmax(axis=1) == table
            a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            for i in np.unique(a):
                met = np.unique(root[np.append(b[a == i], i)])
                if len(met) > 1:
                    root[np.isin(root, met)] = met[0]
        some = links > 0
        return pa.table({"node": nodes[some], "links": links[some], "root": nodes[root[some]]})

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``vectors``: ``(id, n_links, component_id, kept)``."""
    work = workspace(vectors.sparkSession)
    source = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    planes, tables = settings.tables(source.count())
    described = work.keep(source.mapInArrow(
        _describe(planes, tables, settings.seed), "id long, digest binary, payload binary, buckets array<long>, dim int"
    ), "signs")
    able = described.filter("id IS NOT NULL AND digest IS NOT NULL")
    # One row per id and vector, then one per vector.
    classes = (
        able.groupBy("digest", "id").agg(F.lit(1).alias("one"))
        .groupBy("digest").agg(F.min("id").alias("node"), F.count("*").alias("copies"))
    )
    classed = work.keep(able.join(classes, "digest"), "classes")
    firsts = classed.filter("id = node").dropDuplicates(["node", "digest"])
    placed = firsts.select("node", "copies", "payload", "dim", "buckets", F.posexplode("buckets").alias("table", "bucket"))
    counts = (
        firsts.select("dim", F.posexplode("buckets").alias("table", "bucket"))
        .groupBy("dim", "table", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
        .select("dim", "table", "bucket", F.ceil(F.col("n") / settings.block).cast("int").alias("parts"))
    )
    part = F.pmod(F.xxhash64("node"), "parts").cast("int")
    tiles = placed.join(counts, ["dim", "table", "bucket"]).withColumn("part", part).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).select(
        "dim", "table", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
        (F.col("part") > F.col("other")).cast("int").alias("side"), "node", "copies", "payload", "buckets",
    )
    found = work.keep(
        tiles.groupBy("dim", "table", "bucket", "i", "j")
        .applyInArrow(_tile_links(settings.threshold), "node long, links long, root long"), "found",
    )
    copies = classed.select(F.col("id").alias("u"), F.col("node").alias("v"))
    stars = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(copies), work, "links")
    others = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_id = (
        classed.groupBy("id", "digest").agg(F.min("node").alias("node"), F.min("copies").alias("copies"))
        .join(others, "node", "left")
        .groupBy("id").agg(F.sum(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        .withColumnRenamed("id", "of")
    )
    result = described.select("id").join(per_id, F.col("id") == F.col("of"), "left").join(
        stars, F.col("id") == F.col("node"), "left"
    )
    component = F.coalesce("component", "id")
    return result.select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
