"""Connected components of links that lie in a table, without a driver or a task that sees them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnish.functions.storage import through_table

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node it can reach.

    Alternates large-star and small-star steps (Kiveris and others, 2014), each a
    grouping and a join that shuffle the links alone; a table cuts the lineage
    after each round. A node with very many links is combined before the shuffle
    and split by adaptive execution in the join.
    """
    edges = through_table(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    seen = _digest(edges)
    for _ in range(MAX_ROUNDS):
        edges = through_table(_small_star(_large_star(edges)), "links")
        now = _digest(edges)
        if now == seen:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        seen = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m")).select("of", F.least("of", "m").alias("m"))
    larger = both.where("b > a").join(least, F.col("a") == F.col("of"))
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("of")).agg(F.min("b").alias("m"))
    smaller = edges.join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("of").alias("a"), F.col("m").alias("b"))
    return smaller.unionByName(own).where("a > b").distinct()
