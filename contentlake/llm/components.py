"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def _parents(edges: DataFrame) -> DataFrame:
    """(v, p): the smallest of a vertex and its neighbours; partial minima, so hubs do no harm."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
    return both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("p"))


def components(edges: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex of each vertex's component, for all vertices with an edge.

    ``edges`` has a and b. Each round hooks every vertex to its smallest neighbour, follows two
    hooks, and replaces the edges by those between the parents; their number falls every round.
    All states are tables in the shared folder, so a lost executor costs a task.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    label = None
    while edges.observed["rows"]:
        parent = materialize(_parents(edges), "parents")
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        jumped = materialize(parent.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p")), "parents")
        if label is None:
            label = jumped.select("v", F.col("p").alias("label"))
        else:
            step = jumped.select(F.col("v").alias("label"), "p")
            label = materialize(label.join(step, "label", "left").select("v", F.coalesce("p", "label").alias("label")), "labels")
        a = jumped.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        b = jumped.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        moved = edges.join(a, "a").join(b, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        edges = materialize(moved.filter("a <> b").distinct(), "edges")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("label")) if label is None else label
