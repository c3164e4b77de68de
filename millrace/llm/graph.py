"""Connected components of a link table, by alternating stars; the links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """links: a, b of one orderable type. A row (node, label) for each node; label is the component's smallest node.

    Large star: every node tells its larger neighbours the smallest node it knows. Small star: every node tells its
    smaller neighbours. Both shrink paths to stars and never add links, so that a round costs what the links cost.
    What the nodes know is written before it is joined to the links: both sides of the join are then dealt for it alone,
    and Spark can split the links of a hub among tasks.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = materialize(links.filter("a <> b").select(larger, smaller).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = materialize(large, "edges")
        down = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        small = large.join(down, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return nodes.unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksums of the edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(7)))).first())
