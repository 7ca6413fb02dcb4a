"""Connected components of a distributed edge list by alternating large-star and small-star rounds.

A large-star round hangs every larger neighbour of a node on the node's smallest neighbour, a
small-star round every smaller one. Both keep components as they are; the edges become stars
around each component's smallest node after a number of rounds logarithmic in the size.
Every round is one aggregate (reduced before its shuffle) and one equi-join, which adaptive
execution may split on a node with very many neighbours. No adjacency list is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Stored

MAX_ROUNDS = 200


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b")))


def _mark(edges: DataFrame) -> tuple:
    pair = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(pair)).first())


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """One row (node, component) for every node with an edge to another; component is its smallest node.

    ``edges`` has two columns of one ordered type. Order, repeated edges, loops and edges with a
    null end do not matter; a node that only has such loops is not returned.
    """
    first, second = (F.col(name) for name in edges.columns[:2])
    pairs = edges.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    current = Stored(pairs.filter(first.isNotNull() & second.isNotNull() & (first != second)).distinct(), label)
    mark = _mark(current.df)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        large = Stored(_large_star(current.df).distinct(), label)
        small = Stored(_small_star(large.df).distinct(), label)
        large.drop()
        current.drop()
        current, before = small, mark
        mark = _mark(current.df)
        if mark == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    children = current.df.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return children.unionByName(children.select(F.col("component").alias("node"), "component").distinct())
