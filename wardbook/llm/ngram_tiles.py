"""N-gram Jaccard join in size-banded tiles with bitmap signatures.

Documents with equal shingle sets form a class, and the join runs on one document per class.
Classes that share a min-hash key fall into a family. A family is cut into blocks, a large one
first by bands of set size: sets of which one is over 1.25 times the other cannot reach a
Jaccard similarity of 0.8, so only blocks of one band or of neighbouring bands meet. Two blocks
that meet are a tile, one task's work. In it every document has a bitmap of its hashed shingles.
Bits that only one of two documents has bound their overlap from above, and only pairs that the
bound lets pass are intersected as sorted arrays. For components, pairs already connected within a tile
are skipped, so a tile returns at most one link per document. ``near_pairs`` skips none and returns every
link between documents of different shingle sets, ``link_counts`` how many links each document has.

Min-hash keys decide which documents meet: a pair of similarity 0.8 shares none of its 32 keys
(3 minima each) with probability 1e-10, a closer pair less. Every pair that meets is decided
exactly, up to collisions of 64-bit hashes.

Defined results: a text without words, or null, has no shingles and no links. A row without id
has a null component and links with nothing. Rows that repeat an id are one document: links of
any of them count for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardbook.llm.common import unused_name, workspace
from wardbook.llm.components import components
from wardbook.llm.shingles import min_hash_keys, shingle_sets, slices
from wardbook.sources.tables import Workspace


@dataclass(frozen=True)
class Settings:
    """``percent`` is the least similarity times 100; blocks hold about ``block_weight``."""

    width: int = 5
    percent: int = 80
    rows: int = 3
    bands: int = 32
    block_weight: int = 2_000_000
    #: What a document weighs in a block beside its shingles, so that blocks of short ones end too.
    document_weight: int = 500


def _describe(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("id")
            for part in slices(texts):
                sets = shingle_sets(texts[part], settings.width)
                full = [s for s in sets if len(s)]
                keys = iter(min_hash_keys(full, settings.rows, settings.bands)) if full else iter(())
                yield pa.RecordBatch.from_arrays([
                    ids.slice(part.start, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ], ["id", "n", "digest", "keys"])

    return run


def _shingle_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for part in slices(texts):
                sets = shingle_sets(texts[part], width)
                yield pa.RecordBatch.from_arrays([
                    batch.column("node").slice(part.start, len(sets)),
                    batch.column("tiles").slice(part.start, len(sets)),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ], ["node", "tiles", "shingles"])

    return run


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 64-bit words per set, about four bits wide per shingle of the largest."""
    largest = max(len(s) for s in sets)
    bits = 1 << int(np.clip(np.ceil(np.log2(4 * max(1, largest))), 8, 14))
    out = np.zeros((len(sets), bits // 64), dtype=np.uint64)
    for row, s in zip(out, sets):
        at = s & np.uint64(bits - 1)
        np.bitwise_or.at(row, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return out


class _Tile:
    """The sets of a tile in order of size, and which pairs of them are similar."""

    def __init__(self, sets: list[np.ndarray], side: np.ndarray, percent: int):
        sizes = np.array([len(s) for s in sets])
        self.order = np.argsort(sizes, kind="stable")
        self.sizes, self.side, self.percent = sizes[self.order], side[self.order], percent
        self.sets = [sets[i] for i in self.order]
        self.bits = bitmaps(self.sets)
        self.ones = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.crossing = len(np.unique(side)) > 1
        self.highs = np.searchsorted(self.sizes * percent, self.sizes * 100, side="right")

    def possible(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that sizes, sides and bitmaps let pass. Pairs of one side pass only if there is no other."""
        if self.crossing:
            others = others[self.side[others] != self.side[i]]
        if not len(others):
            return others
        both = np.bitwise_count(self.bits[others] & self.bits[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum(self.sizes[i] - (self.ones[i] - both), self.sizes[others] - (self.ones[others] - both))
        return others[100 * most >= self.percent * (self.sizes[i] + self.sizes[others] - most)]

    def linked(self, i: int, j: int) -> bool:
        shared = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
        return 100 * shared >= self.percent * (self.sizes[i] + self.sizes[j] - shared)


def linked_roots(sets: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """Per set the index that stands for its component within the tile."""
    tile = _Tile(sets, side, percent)
    root = np.arange(len(sets))
    for i in range(len(sets)):
        others = np.arange(i + 1, tile.highs[i])
        for j in tile.possible(i, others[root[others] != root[i]]):
            if root[j] != root[i] and tile.linked(i, j):
                root[root == root[j]] = root[i]
    back = np.empty_like(tile.order)
    back[tile.order] = np.arange(len(tile.order))
    return tile.order[root[back]]


def linked_pairs(sets: list[np.ndarray], side: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Every pair of similar sets, as indices."""
    tile = _Tile(sets, side, percent)
    for i in range(len(sets)):
        for j in tile.possible(i, np.arange(i + 1, tile.highs[i])):
            if tile.linked(i, j):
                yield int(tile.order[i]), int(tile.order[j])


def _tile_links(percent: int, every: bool):
    def run(tile: pa.Table) -> pa.Table:
        sets = [np.frombuffer(s, dtype=np.uint64) for s in tile["shingles"].to_pylist()]
        nodes, side = tile["node"].to_numpy(), tile["side"].to_numpy()
        if every:
            pairs = np.array(list(linked_pairs(sets, side, percent)), dtype=np.int64).reshape(-1, 2)
            return pa.table({"u": nodes[pairs[:, 0]], "v": nodes[pairs[:, 1]]})
        roots = nodes[linked_roots(sets, side, percent)]
        linked = nodes != roots
        return pa.table({"u": nodes[linked], "v": roots[linked]})

    return run


def _tiles(members: DataFrame, settings: Settings) -> DataFrame:
    """``(node, tiles)``: per document the tiles it takes part in.

    A tile is named by its two blocks, and a block by band and part. A family below one block's
    weight is a single band with a single part.
    """
    weight = F.col("n") + settings.document_weight
    whole = members.groupBy("family").agg(F.sum(weight).alias("total"))
    band = F.when(F.col("total") <= settings.block_weight, 0).otherwise(
        F.floor(F.log("n") / F.log(F.lit(100 / settings.percent)))
    ).cast("int")
    banded = members.join(whole, "family").select("node", "family", "n", band.alias("band"))
    parts = banded.groupBy("family", "band").agg(
        F.ceil(F.sum(weight) / settings.block_weight).cast("int").alias("parts")
    )

    def beside(step: int, name: str) -> DataFrame:
        return parts.select("family", (F.col("band") - step).alias("band"), F.col("parts").alias(name))

    counted = (
        banded.join(parts, ["family", "band"])
        .join(beside(1, "above"), ["family", "band"], "left")
        .join(beside(-1, "below"), ["family", "band"], "left")
        .withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    )

    def tile(low: Column, i: Column, high: Column, j: Column, side: Column) -> Column:
        return F.struct(
            F.col("family").alias("family"), low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"),
            side.cast("int").alias("side"),
        )

    def each(n: Column, make) -> Column:
        none = F.array().cast("array<int>")
        return F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none), make)

    band, part = F.col("band"), F.col("part")
    tiles = F.concat(
        each(F.col("parts"), lambda j: tile(band, F.least(part, j), band, F.greatest(part, j), part > j)),
        each(F.coalesce("above", F.lit(0)), lambda j: tile(band, part, band + 1, j, F.lit(0))),
        each(F.coalesce("below", F.lit(0)), lambda j: tile(band - 1, j, band, part, F.lit(1))),
    )
    return counted.select("node", tiles.alias("tiles"))


def _classes(source: DataFrame, work: Workspace, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Size, digest and keys of every row, and the class of those with an id and words."""
    described = work.keep(
        source.mapInArrow(_describe(settings), "id long, n long, digest binary, keys array<long>"), "sets"
    )
    able = described.filter("id IS NOT NULL AND n > 0")
    classes = able.groupBy("digest").agg(F.min("id").alias("node"))
    return described, work.keep(able.join(classes, "digest").select("id", "node", "n", "keys"), "classes")


def _links(source: DataFrame, classed: DataFrame, work: Workspace, settings: Settings, every: bool) -> DataFrame:
    """``(u, v)``: links between classes, all of them or enough to connect what is connected."""
    firsts = classed.filter("id = node")
    rows = firsts.select("node", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low < high")
    met = rows.join(shared.select("key", "low"), "key").select(F.col("node").alias("u"), F.col("low").alias("v"))
    families = components(met, work, "families").toDF("node", "family")
    members = firsts.join(families, "node").groupBy("node", "family").agg(F.max("n").alias("n"))
    tiles = work.keep(_tiles(members, settings), "tiles")

    # Texts are shuffled once at any size; tables of tiles grow with the input, so none is broadcast.
    sets = (
        source.withColumnRenamed("id", "node").join(tiles.hint("shuffle_hash"), "node")
        .mapInArrow(_shingle_rows(settings.width), f"node long, tiles {dict(tiles.dtypes)['tiles']}, shingles binary")
    )
    return (
        sets.select("node", "shingles", F.explode("tiles").alias("t")).select("node", "shingles", "t.*")
        .filter(F.length("shingles") > 0)
        .groupBy("family", "low", "i", "high", "j").applyInArrow(_tile_links(settings.percent, every), "u long, v long")
    )


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``docs``: ``(id, n_shingles, component_id)``."""
    work, source = workspace(docs.sparkSession), _source(docs, id_col, text_col)
    described, classed = _classes(source, work, settings)
    links = _links(source, classed, work, settings, every=False)
    copies = classed.filter("id <> node").select(F.col("id").alias("u"), F.col("node").alias("v"))
    found = components(links.unionByName(copies), work, "links")
    return described.join(found, F.col("id") == F.col("node"), "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id")
    )


def near_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """Links ``(u, v)``, u < v, between classes of equal shingle sets, and the classes as ``(id, node)``.

    A class is named by its least id. Work and rows grow with the number of links.
    """
    work, source = workspace(docs.sparkSession), _source(docs, id_col, text_col)
    _, classed = _classes(source, work, settings)
    links = _links(source, classed, work, settings, every=True)
    pairs = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u < v").distinct()
    return work.keep(pairs, "pairs"), classed.select("id", "node").distinct()


def link_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """``(id, n_links)``: how many other ids each id with words is linked to, copies included."""
    pairs, classes = near_pairs(docs, id_col, text_col, settings)
    sizes = classes.groupBy("node").agg(F.count("*").alias("size"))
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    beyond = both.join(sizes.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.sum("size").alias("beyond"))
    counts = sizes.join(beyond, "node", "left").select(
        "node", (F.col("size") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"))
    return classes.join(counts, "node").groupBy("id").agg(F.max("n_links").alias("n_links"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The document with the least id of each group; rows without id stay."""
    name = unused_name(docs.columns, "__later")
    later = near_copies(docs, id_col, text_col, settings).filter("id <> component_id").select(
        F.col("id").alias(name)
    ).distinct()
    return docs.join(later.hint("shuffle_hash"), F.col(f"`{id_col}`") == F.col(name), "left_anti")
