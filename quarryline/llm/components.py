"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.session import pin


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's greater neighbours are tied to its least neighbour (or to itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u").where(F.col("v") > F.col("u"))
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its lesser neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def least_of_component(edges: DataFrame) -> DataFrame:
    """(node, least) for every node of (u, v) edges but the least ones themselves.

    Minimums are combined in every task before the shuffle, and the joins have one
    row for a node on one side, so a hub is split like any skewed join.  Rounds end
    when a round changes nothing; each round is written to the shared folder.
    """
    tied = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    tied = pin(tied)
    before = _state(tied)
    while True:
        tied = pin(_small_star(_large_star(tied)))
        after = _state(tied)
        if after == before:
            return tied.select(F.col("u").alias("node"), F.col("v").alias("least"))
        before = after
