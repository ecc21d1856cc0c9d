"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from every node of ``edges`` (columns a, b).

    Alternating star contraction: the large-star step hooks every larger
    neighbour of a node to the smallest node it sees, the small-star step does
    the same with the smaller ones; both keep reachability, and the edges end
    as one star per component. The rounds grow with the logarithm of the
    number of nodes, not with the length of a chain. Each step is one minimum
    per node (combined before the shuffle) and one join; a hub's many edges
    are an ordinary skewed join, which AQE splits. Only a row count and a
    checksum reach the driver. Every round is stored on the shared folder, so a
    lost executor costs the current round at most.

    Loops, repeated edges and either direction are accepted; edges with a null
    end are ignored. Returns (node, root) for each node that has an edge to
    another node.
    """
    edges = stored(_oriented(edges.select("a", "b")))
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*").alias("n"),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def _oriented(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return (edges.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hook the larger neighbours of every node to its smallest neighbour, or itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = both.where(F.col("b") > F.col("a"))
    return _oriented(larger.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hook a node and its smaller neighbours to the smallest of these."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionByName(low.select("a", F.col("m").alias("b"))))
