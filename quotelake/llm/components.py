"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, last_kept


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round. Each node's least neighbour is a partial aggregate, and the join back can be split where a node has very many edges."""
    if large:
        edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = edges.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.where(F.col("u") != F.col("v")).distinct()
    out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(least.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node with an edge, from ``(u, v)`` of one orderable type; root: the least node reachable.

    Each round is written to the shared folder; rounds grow with the logarithm
    of the graph's size. Loops and repeated edges do no harm; an empty table
    gives an empty result.
    """
    directed = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v")).distinct()
    with last_kept(edges.sparkSession):
        edges, before = cut(directed, "edges"), None
        while True:
            edges = cut(_stars(_stars(edges, large=True), large=False), "stars")
            # Done when nothing moves: the edges are stars, and a round over stars gives them again.
            state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if state == before or state[0] == 0:
                break
            before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
