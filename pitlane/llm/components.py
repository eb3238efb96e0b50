"""Connected components of a table of edges, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pitlane.sources import shared


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _neighbours(edges: DataFrame) -> tuple[DataFrame, bool]:
    """``node, least`` (the least node among a node and its neighbours), and whether the edges are stars already.

    They are if a node with a smaller neighbour has no other; that is seen while the rows are written.
    """
    seen = Observation()
    smaller = F.count_if(F.col("b") < F.col("a"))
    counted = _both(edges).groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("least"), ((smaller > 0) & (F.count("*") > 1)).alias("more")
    ).observe(seen, F.count_if("more").alias("more"))
    return shared.store(counted.select("node", "least"), "least"), seen.get["more"] == 0


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of all nodes of ``edges`` (``a, b``): the label is the least node reachable.

    Each round hangs every larger neighbour of a node on the least one, then
    does the same among the smaller ones. Paths shorten by half, so rounds are
    few; each round's edges are stored, which cuts the lineage. The lookups of
    a node's least neighbour are stored as well, so that a node with many edges
    can be split by the adaptive join. Edges that are stars need no more rounds.
    """
    edges = shared.store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while not edges.isEmpty():
        least, stars = _neighbours(edges)
        if stars:
            break
        large = _both(edges).join(least, F.col("a") == F.col("node")).filter("b > a").select(
            F.col("b").alias("a"), F.col("least").alias("b")
        )
        # Nodes that are the least of all around them keep no edge of their own.
        large = shared.store(large.filter("a <> b"), "large_star")
        least = shared.store(large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")
        hung = large.join(least, F.col("a") == F.col("node")).select(
            F.explode(F.array(
                F.struct(F.col("a"), F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b"))
            )).alias("e")
        ).select("e.a", "e.b")
        edges = shared.store(hung.filter("a <> b").distinct(), "small_star")
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
