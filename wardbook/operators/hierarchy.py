"""Trees: one row per leaf with its ancestors' names, from paths or from parent links of any depth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.sources.tables import Workspace


def flatten_hierarchy(
    nodes: DataFrame,
    leaf_level: int,
    level_names: Mapping[int, str],
    id: str = "id",
    name: str = "name",
    level: str = "level",
    path: str = "path",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per node at ``leaf_level``: ``id``, ``name``, ``level``, ``carry`` and one
    ancestor-name column per entry of ``level_names``.

    ``nodes`` has one row per id. A leaf is kept if its path holds the leaf itself or any node
    above or below leaf level; a missing ancestor leaves a null name. Each leaf resolves
    itself, so only inner nodes are joined: a side that stays small while leaves grow. The
    levels are named up front, hence no job to discover pivot columns, and the conditional
    aggregate folds a leaf's path back to one row before the shuffle.
    """
    parts = F.split(F.regexp_replace(path, "^/", ""), "/")
    leaves = (
        nodes.filter(F.col(level) == leaf_level)
        .select(id, name, level, *carry, parts.alias("__parts"))
        .filter(F.col("__parts").isNotNull())
        .withColumn("__in_path", F.array_contains("__parts", F.col(id)))
    )
    inner = nodes.filter(~F.col(level).eqNullSafe(leaf_level)).select(
        F.col(id).alias("__ancestor"),
        F.col(name).alias("__ancestor_name"),
        F.col(level).alias("__ancestor_level"),
        F.lit(True).alias("__found"),
    )
    steps = leaves.withColumn("__ancestor", F.explode("__parts")).drop("__parts")
    return (
        steps.join(inner, "__ancestor", "left")
        .groupBy(id, name, level, *carry)
        .agg(
            F.max(F.col("__in_path") | F.col("__found").isNotNull()).alias("__keep"),
            *[
                F.max(F.when(F.col("__ancestor_level") == n, F.col("__ancestor_name"))).alias(column)
                for n, column in level_names.items()
            ],
        )
        .filter("__keep")
        .drop("__keep")
    )


def paths_from_parents(
    nodes: DataFrame, work: Workspace, id: str = "id", parent: str = "parent", path: str = "path", depth: str = "depth",
    cyclic: str = "is_cyclic",
) -> DataFrame:
    """``nodes`` with the path from the root, its number of nodes, and whether the links run in a circle.

    A path reads ``/root/.../node``. A node without a parent, or with one that is not there, is a
    root. Nodes in a circle, and those that lead into one, have neither path nor depth.

    Every node points at an ancestor and holds the ids up to it. A round lets each take over where
    its ancestor points, so paths double: a tree of depth 1000 takes ten rounds and a last one. A
    pointer that is on its own path has come round, and is not followed. Rounds are written,
    so that a lost executor costs a re-read; only their counts of open pointers reach the driver.
    """
    known = nodes.select(F.col(id).alias("__parent")).filter(F.col("__parent").isNotNull()).distinct()
    links = nodes.filter(F.col(id).isNotNull()).select(F.col(id).alias("node"), F.col(parent).alias("__parent"))
    state = work.keep(
        links.join(known.withColumn("__known", F.lit(True)), "__parent", "left").select(
            "node", F.when(F.col("__known"), F.col("__parent")).alias("up"), F.array("node").alias("ids"),
            F.lit(False).alias("circle"),
        ).dropDuplicates(["node"]),
        "paths-0",
    )
    for turn in count(1):
        if state.filter(F.col("up").isNotNull()).isEmpty():
            break
        above = state.select(
            F.col("node").alias("up"), F.col("up").alias("next"), F.col("ids").alias("more"), F.col("circle").alias("above"))
        ids = F.concat(F.coalesce("more", F.array().cast(state.schema["ids"].dataType)), "ids")
        joined = state.join(above, "up", "left").select("node", "next", ids.alias("ids"), (
            F.col("circle") | F.coalesce("above", F.lit(False))).alias("circle"))
        round_again = F.col("next").isNotNull() & F.array_contains("ids", F.col("next"))
        state = work.keep(joined.select(
            "node", F.when(~round_again & ~F.col("circle"), F.col("next")).alias("up"),
            F.when(~round_again & ~F.col("circle"), F.col("ids")).otherwise(F.array("node")).alias("ids"),
            (F.col("circle") | F.coalesce(round_again, F.lit(False))).alias("circle"),
        ), f"paths-{turn}")
    found = state.select(
        F.col("node").alias(id), F.when(~F.col("circle"), F.concat(F.lit("/"), F.array_join("ids", "/"))).alias(path),
        F.when(~F.col("circle"), F.size("ids")).alias(depth), F.col("circle").alias(cyclic),
    )
    return nodes.join(found, id, "left")
