"""Connected components of an edge table by alternating large and small stars, all of it distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.llm.store import stage, unstage


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` to ``(node, component)``, where the component is its smallest node.

    Each round keeps connectivity and shortens paths, and ends when the edges are stars around their smallest node.
    Nodes without an edge are not returned.  Self loops and repeated edges do no harm; null ends are ignored.  A hub with
    a large part of all edges is met by partial aggregation and by a plain equi-join that adaptive execution may split.
    """
    edges = edges.where("a is not null and b is not null and a <> b")
    current = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "large-star")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stage(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        unstage(current)  # written anew, so nothing reads the round before any more
        unstage(large)
        current = after
        now = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if before == (now["n"], now["x"]):
            break
        before = (now["n"], now["x"])
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
