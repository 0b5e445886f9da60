"""Connected components over a table of links, as rounds of joins.

Each round lets every node pass its larger neighbours on to its least one, and then its smaller
ones (the large-star and small-star steps of Kiveris et al., 2014), until all links are stars
around the least node. A round is written and read again: a lost executor costs a re-read, and
no link, node or component comes to the driver. A node with many links is not gathered: minima
fold before the shuffle, and Spark splits the join on a hot node.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardbook.sources.tables import Workspace


def _to_least(links: DataFrame) -> DataFrame:
    """``(u, v, least)``: each link with the least of ``u`` and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    return links.join(least, "u").withColumn("least", F.least("u", "least"))


def _round(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    small = _to_least(large)
    own, others = F.struct(F.col("u").alias("u")), F.struct(F.col("v").alias("u"))
    return (
        small.select("least", F.explode(F.array(own, others)).alias("n"))
        .filter("n.u <> least").select("n.u", F.col("least").alias("v")).distinct()
    )


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``(node, component)`` for every node that a link ``(u, v)`` joins to another.

    A component is named by its least node. Links to oneself and null ends are left out.
    """
    pairs = work.keep(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        f"{name}-links",
    )
    seen = None
    for turn in count():
        state = pairs.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == seen:
            break
        seen = state
        pairs = work.keep(_round(pairs), f"{name}-{turn}")
    centres = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
