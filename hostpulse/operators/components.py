"""Connected components of a table of links, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hostpulse.session import materialise


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of `links` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps: each links a node's neighbours to its smallest neighbour, so the links turn
    into stars within a number of rounds that grows with the logarithm of the longest path. A node with very many neighbours
    is only ever combined by minimum before a shuffle, or joined on a side that adaptive execution may split. Every round is a
    written table.
    """
    edges = materialise(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    known = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours of a node go to the smallest of its neighbourhood.
        large = both.where("b > a").join(smallest, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        large = materialise(large, "large-star")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lowest, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
        small = small.unionByName(lowest.select(F.col("m").alias("a"), "b")).where("a <> b").distinct()
        edges = materialise(small, "small-star")
        # Stars are left alone by both steps; a checksum of the links tells whether anything moved.
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if tuple(state) == known:
            roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
        known = tuple(state)
    raise RuntimeError("components did not settle")
