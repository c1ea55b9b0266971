"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import stored

MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """Edges hung on the least node among each node and its neighbours."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _all_stars(edges: DataFrame) -> bool:
    """Whether no node hangs on two others, or hangs itself while others hang on it."""
    ends = edges.select("u", F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(edges.select(F.col("v").alias("u"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    found = ends.groupBy("u").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return found.where("hangs > 1 or hangs = 1 and holds = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of `links` (a, b: bigint); root is the least node it reaches.

    Each round hangs every larger neighbour on a node's least neighbour, then the same among
    smaller ones. Rounds end when all edges are stars: every node hangs on one other at most, and
    none that others hang on hangs itself. Every round is written to the shared folder, so lineage
    stays short and nothing is collected but whether a node breaks that rule.
    """
    edges = stored(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    for _ in range(MAX_ROUNDS):
        if _all_stars(edges):
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = large.join(_least(large), "u")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.*").where("u != v").distinct(), "edges")
    else:
        raise RuntimeError(f"not all stars after {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
