"""Subtree totals of a distributed forest by parallel tree contraction.

Rounds of joins alternate two steps until only roots are left. *Rake*: every leaf is taken away and its
total added to its parent, by an aggregate that is reduced before its shuffle, so a parent
of a third of all nodes costs one row per task. *Compress*: in chains of nodes with one child, a node whose
coin shows heads and whose child's coin shows tails is spliced out; its weight moves to the edge above the child. Leaves of bushy
trees go in rounds logarithmic in the size, and so do chains, however long: the coin takes a quarter of a chain each round.

A leaf's total is known when it is raked. A spliced node remembers its child and what lies between the two,
so the rounds, read backwards, give its total from its child's: the re-expansion.

Nodes are named by two long columns, ``a`` and ``b``. All joins are on keys that are unique on both
sides, so none of them can be skewed. Each round is written and the last one deleted; a lost
executor costs the tasks of one round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Stored

MAX_ROUNDS = 500
NODE = ["a", "b"]


def _heads(a: str, b: str, step: int) -> Column:
    return F.xxhash64(F.lit(step), a, b).bitwiseAND(F.lit(1)) == 1


def _kids(nodes: DataFrame, values: list[str]) -> DataFrame:
    """Per parent: what its leaves add, how many children stay, and the one that stays if it is one."""
    leaf = F.col("n_left") == 0
    sums = [F.coalesce(F.sum(F.when(leaf, F.col(f"own_{v}") + F.col(f"edge_{v}"))), F.lit(0)).alias(f"add_{v}") for v in values]
    stays = [F.sum(F.when(leaf, 0).otherwise(1)).alias("stay"), F.max(F.when(~leaf, F.col("a"))).alias("only_a"), F.max(F.when(~leaf, F.col("b"))).alias("only_b")]
    return nodes.filter("pa is not null").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(*sums, *stays)


def _round(nodes: DataFrame, values: list[str], step: int) -> DataFrame:
    """One rake and one compress; rows of spliced nodes come back with ``spliced``."""
    inner = nodes.filter((F.col("n_left") > 0) | F.col("pa").isNull()).join(_kids(nodes, values), NODE, "left").select(
        *NODE, "pa", "pb", F.coalesce("stay", F.lit(0)).alias("n_left"), "only_a", "only_b",
        *[(F.col(f"own_{v}") + F.coalesce(f"add_{v}", F.lit(0))).alias(f"own_{v}") for v in values], *[f"edge_{v}" for v in values],
    )
    spliced = (F.col("n_left") == 1) & F.col("pa").isNotNull() & _heads("a", "b", step) & ~_heads("only_a", "only_b", step)
    return inner.withColumn("spliced", spliced)


def _hang(inner: DataFrame, values: list[str]) -> DataFrame:
    """The nodes that stay, children of spliced ones on their grandparent; ``from_a`` names the node spliced out above."""
    up = inner.filter("spliced").select(
        F.col("only_a").alias("a"), F.col("only_b").alias("b"), F.col("a").alias("from_a"), F.col("b").alias("from_b"),
        F.col("pa").alias("up_a"), F.col("pb").alias("up_b"), *[F.col(f"own_{v}").alias(f"up_own_{v}") for v in values],
        *[F.col(f"edge_{v}").alias(f"up_edge_{v}") for v in values],
    )
    moved = F.col("from_a").isNotNull()
    return inner.filter("not spliced").join(up, NODE, "left").select(
        *NODE, F.when(moved, F.col("up_a")).otherwise(F.col("pa")).alias("pa"), F.when(moved, F.col("up_b")).otherwise(F.col("pb")).alias("pb"),
        "n_left", *[f"own_{v}" for v in values],
        *[(F.col(f"edge_{v}") + F.when(moved, F.col(f"up_own_{v}") + F.col(f"up_edge_{v}")).otherwise(F.lit(0))).alias(f"edge_{v}") for v in values],
        "from_a", "from_b", *[F.when(moved, F.col(f"up_own_{v}") + F.col(f"edge_{v}")).alias(f"gap_{v}") for v in values],
    )


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(a, b, total_<value> ...): for each node the sums over its subtree, itself included.

    ``nodes`` has a and b (the node), pa and pb (its parent, null for a root), n_children and the long columns
    ``values``; nodes are distinct, no name is null and parents are nodes. An empty table gives no rows.
    """
    current = Stored(nodes.select(
        *NODE, "pa", "pb", F.col("n_children").cast("long").alias("n_left"),
        *[F.col(v).cast("long").alias(f"own_{v}") for v in values], *[F.lit(0).cast("long").alias(f"edge_{v}") for v in values],
    ), "contract")
    done, gaps, scratch = [], [], [current]
    for step in range(MAX_ROUNDS):
        open_ = current.df.filter("pa is not null").limit(1).count()
        raked = current.df.filter("n_left = 0" if open_ else "true").filter("pa is not null" if open_ else "true")
        done.append(raked.select(*NODE, *[F.col(f"own_{v}").alias(f"total_{v}") for v in values]))
        if not open_:
            break
        inner = Stored(_round(current.df, values, step), "contract-raked")
        current = Stored(_hang(inner.df, values), "contract-round")
        inner.drop()
        scratch.append(current)
        gaps.append(current.df.filter("from_a is not null").select(
            *NODE, "from_a", "from_b", *[f"gap_{v}" for v in values]))
    else:
        raise RuntimeError(f"no roots alone after {MAX_ROUNDS} rounds: the parents form a cycle")
    known = done.pop()
    for raked, gap in zip(reversed(done), reversed(gaps)):
        # The child of a spliced node left after it, so its total is known by now.
        found = gap.join(known, NODE).select(
            F.col("from_a").alias("a"), F.col("from_b").alias("b"), *[(F.col(f"gap_{v}") + F.col(f"total_{v}")).alias(f"total_{v}") for v in values])
        wider = Stored(known.unionByName(found).unionByName(raked), "contract-totals")
        scratch.append(wider)
        known = wider.df
    for table in scratch[:-1]:
        table.drop()
    return known
