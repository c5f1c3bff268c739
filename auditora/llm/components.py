"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

ROUNDS = 60


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Every node's neighbours (small: the lesser ones) are tied to the least of them and the node."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # The least neighbours are one row a node; a hot node's rows can be split in this join.
    near = both.join(least, "a")
    if small:
        out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    else:
        out = near.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter(F.col("a") != F.col("b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (least node reachable) of every node of edges (a, b), both long; loops are ignored.

    Each round goes to a table in the shared folder; only counts and checksums reach the driver."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(F.col("a") != F.col("b")).distinct(), "edges")
    before = None
    for _ in range(ROUNDS):
        edges = written(_stars(_stars(edges, False), True), "edges")
        state = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = state
    raise RuntimeError("components did not settle")
