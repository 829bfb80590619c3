"""Connected components of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentloom.llm.common import settled


def _star(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Hang neighbours of each node below its smallest neighbour.

    The smallest neighbour is an aggregate (summed before the shuffle); the join back to
    the edges is an ordinary one, so a node with very many links can be split.
    """
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if smaller_only:
        near = down
    else:
        near = down.unionAll(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = near.join(least, "u")
    if smaller_only:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(
            joined.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        moved = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of a link with the smallest node it can reach.

    Links may repeat, point either way, join a node to itself or hold null (the last two
    take no part). Rounds go on until nothing changes; their number grows with the
    logarithm of the largest component. Each round is checkpointed. An empty table of
    links gives an empty result.
    """
    edges = settled(
        links.select(F.col(a).alias("a"), F.col(b).alias("b"))
        .filter("a is not null and b is not null and a <> b").distinct())

    def digest(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    before = digest(edges)
    if before[0] == 0:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:
        edges = settled(_star(_star(edges, smaller_only=False), smaller_only=True))
        after = digest(edges)
        if after == before:
            break
        before = after
    child = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    root = child.select("component").distinct().select(
        F.col("component").alias("node"), "component")
    return child.unionAll(root)
