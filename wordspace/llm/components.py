"""Connected components of a table of links, by alternating star steps.

Each round hangs every node's larger neighbours, then its smaller ones, on the
smallest node it knows; the number of rounds grows with the logarithm of the
longest path. Only node ids move; a node with very many links is partially
aggregated before the shuffle and split by adaptive execution in the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _hang(edges: DataFrame) -> DataFrame:
    """One round on edges (u, v) with u > v."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return small.filter("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of ``links`` (a, b) with the smallest node
    that it reaches."""
    edges = materialize(links.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")).filter("u > v").distinct())
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if now == seen:
            break
        seen = now
        edges = materialize(_hang(edges))
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(roots.join(edges.select(F.col("u").alias("node")), "node", "left_anti").withColumn("component", F.col("node")))
