"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfold.llm.common import saved


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def star_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v long): root is its component's least node.

    Each round hangs a node's neighbours under the least of them, first those
    above it, then those below; the number of rounds grows with the logarithm
    of the longest path.  Minima are combined before the shuffle and joined
    back, so no node's neighbours meet in one task; rounds are written to the
    shared folder.  Self-links, repeated links and an empty table are fine.
    """
    edges = links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_least(both), "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        low = large.join(_least(large), "u")
        edges = saved(
            low.select("u", F.col("m").alias("v")).unionByName(low.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(),
            "stars",
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
