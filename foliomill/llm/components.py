"""Connected components of a graph that stays distributed: alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm import common


def _star(edges: DataFrame) -> DataFrame:
    """Each node u with the smallest of itself and its neighbours, beside every neighbour."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return found.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest of them."""
    found = _star(edges)
    own = found.select("u", F.col("m").alias("v"))
    rest = found.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.union(rest).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (u, v: long); root is the component's smallest node.

    Loops, repeated links, links in both directions and rows with a null end are allowed; nulls are
    dropped. Each round writes its links to the shared folder, so a lost executor costs one round at
    most. The number of rounds grows with the logarithm of the number of nodes. An edge table
    without rows gives no rows.
    """
    links = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links, seen = common.written(links, "links"), None
    for _ in range(most_rounds):
        links = common.written(_small_star(_large_star(links)), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
