"""Connected components of a graph given as a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusops.llm.store import Workspace


def _min_neighbour(both: DataFrame) -> DataFrame:
    return both.groupBy("u").agg(F.min("v").alias("least"))


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, component) for every node of `links` (a, b longs); the component is its least node.

    Large-star: the greater neighbours of a node are linked to its least neighbour. Small-star: the node and its smaller neighbours
    are linked to the least of them. Both keep components, and the rounds grow with the logarithm of the node count. Each round is
    a table in the shared folder. Minima are combined before the shuffle; the joins are plain, so a node with very many links is
    split by adaptive execution.
    """
    links = work.keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    seen = None
    for step in range(1, 64):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _min_neighbour(both).select("u", F.least("u", "least").alias("least"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = large.join(_min_neighbour(large), "u")
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        links = work.keep(small, f"{name}-{step}")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31)), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise ArithmeticError("components have not settled after 63 rounds")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(nodes.select(F.col("component").alias("node"), "component").distinct())
