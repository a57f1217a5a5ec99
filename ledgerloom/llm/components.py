"""Connected components of a graph given as an edge table, by alternating star contractions.

Each round rewires edges towards the smallest neighbour: first the larger neighbours of each node
(large star), then the smaller ones (small star).  The forest becomes stars after a number of rounds
that grows with the logarithm of the number of nodes.  A node's minimum is a partial aggregate, and it
is joined back to the edges, so no task gathers a node's neighbours.  Every round ends in a
checkpoint in the shared folder; the driver only sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed


def _towards_least(edges: DataFrame) -> DataFrame:
    """Large star, then small star, on edges (u > v)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(least.where("m < u").select("u", F.col("m").alias("v")))).where("u > v").distinct()
    smallest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(smallest.select("u", F.col("m").alias("v"))))
    return small.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of any orientation, repeats and loops allowed: (node, root) for each node that has an
    edge to another one; root is the smallest node of its component."""
    state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct())
    before = state(now)
    while before[0]:
        now = checkpointed(_towards_least(now))
        after = state(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
