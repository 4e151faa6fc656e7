"""Connected components by the alternating large-star and small-star steps.

Each step takes the smallest neighbour of every node with a partial aggregate and joins it back, so a node with very many edges never gathers in
one task: the join can be split and the aggregate combines before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import staged

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``: the smallest node that it is connected with.

    Rows with a null end and edges from a node to itself say nothing and are left out.
    """
    now = staged(_directed(edges.select("a", "b")).distinct(), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        after = staged(_small_star(_large_star(now)), "edges")
        seen = after.agg(F.count("a").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen.n, seen.h) == state:
            break
        state, now = (seen.n, seen.h), after
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component")).distinct()


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge from its larger to its smaller end."""
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, F.col("a") == F.col("u")).filter("b > a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    linked = edges.join(least, F.col("a") == F.col("u"))
    out = linked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()
