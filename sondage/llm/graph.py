"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.distribute import materialize


def _parents(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every vertex, itself included."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(
        edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    return both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("p"))


def _jump(parents: DataFrame) -> DataFrame:
    """Replace parents by roots: each round halves the depth of the trees."""
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        nxt = materialize(parents.join(up, "p").select("v", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")))
        parents = nxt.select("v", "p")
        if nxt.filter("moved").limit(1).count() == 0:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``(v, component)`` with the smallest reachable vertex, for every vertex of an edge ``(a, b)``.

    In each round a vertex takes its smallest neighbour as parent, trees are flattened by
    pointer jumping, and the edges are contracted to the roots; at least half of the roots that
    still have an edge vanish. Every table between two joins is written, so that adaptive
    execution can split the rows of a vertex with very many edges."""
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct())
    labels = None
    while edges.limit(1).count():
        roots = _jump(materialize(_parents(edges)))
        if labels is None:
            labels = roots.withColumnRenamed("p", "component")
        else:
            step = roots.select(F.col("v").alias("component"), F.col("p").alias("_next"))
            labels = materialize(labels.join(step, "component", "left").select(
                "v", F.coalesce("_next", "component").alias("component")))
        left = edges.join(roots.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a").select("pa", "b")
        left = materialize(left)
        both = left.join(roots.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = materialize(both.filter("a <> b").distinct())
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("component"))
    return labels
