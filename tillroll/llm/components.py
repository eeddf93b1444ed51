"""Connected components of a graph given by its edges.

Alternating stars: every node's larger neighbours are tied to its least one, then its smaller neighbours
are, until each component is a star around its least node. Minima are combined before each shuffle, and
edges shrink to one per node. Every round is written to the shared folder, so lost executors cost a
round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.scratch import pin


def connected(edges: DataFrame) -> DataFrame:
    """``node, label`` for each node of the edges ``a, b``; the label is the component's least node."""
    stars = pin(_ordered(edges), "stars")
    state = _state(stars)
    while True:
        stars = pin(_small_star(_large_star(stars)), "stars")
        before, state = state, _state(stars)
        if state == before:
            break
    named = stars.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return named.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges ``u, v`` with ``u > v``."""
    return (
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )


def _state(stars: DataFrame) -> tuple:
    """Rows and an order-free digest of the edges."""
    return tuple(
        stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    )


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # Larger neighbours of u are the rows of ``stars`` that have u as their smaller end.
    return (
        stars.select(F.col("v").alias("u"), F.col("u").alias("far"))
        .join(least, "u")
        .select(F.col("far").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return least.select("u", F.col("m").alias("v")).unionByName(moved).distinct()
