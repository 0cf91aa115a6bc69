"""Connected components of links between documents."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notemill.session import materialise


def _stars(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest one (both directions of a link count)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _inward(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node itself, move to the smallest of them. Links lead downwards."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").filter(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of a link can reach. ``links`` has columns a and b.

    Rounds of large and small stars, each written to shared scratch, until nothing moves; their number grows with
    the logarithm of the longest path. Repeated links and links of a node with itself do no harm.
    """
    def state(frame):
        row = frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = state(edges)
    while before[0]:
        edges = materialise(_inward(_stars(edges).distinct()).distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
