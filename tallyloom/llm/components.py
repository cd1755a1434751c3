"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, the larger end first; loops are left out."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _smallest(pairs: DataFrame) -> DataFrame:
    """Per node the smallest of itself and its neighbours. Partial minima shrink a hot node first."""
    return pairs.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_smallest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    linked = edges.join(_smallest(edges), "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(linked.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a long, b long)``; the root is the smallest node.

    Large-star and small-star rounds turn every component into a star in a number of rounds that
    grows with the logarithm of its size. Each round is kept as a table in the shared folder, so
    plans stay short and a lost executor costs at most one round. Only a count and a checksum
    reach the driver.
    """
    state, stars = None, cut_lineage(_ordered(edges))
    while True:
        stars = cut_lineage(_ordered(_small_star(_ordered(_large_star(stars)))))
        now = stars.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("cast(b as decimal(38, 0))"))).first()
        if now == state:
            break
        state = now
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
