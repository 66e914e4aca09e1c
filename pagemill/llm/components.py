"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(a, b) links, two comparable columns of one type, to (node, root).

    ``root`` is the smallest node reachable from ``node``. Only nodes with a link are returned; an
    empty table gives an empty one. Each round is two aggregates combined before their shuffle and
    two joins, so a node with very many links is never gathered in one task; its rounds grow with
    the logarithm of the longest chain. A round's links are written to the shared folder.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        now = edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
        edges = cut_lineage(_small_star(_large_star(edges)))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b")).where("a <> b")
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()
