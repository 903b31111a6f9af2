"""Connected components by repeated contraction, with a written table after every round.

Each round hooks every vertex to the neighbour (or itself) with the smallest per-round hash, relabels, and keeps
only edges between different labels, so the edge table shrinks by a constant factor in expectation. All minima are
plain aggregates with map-side combine; the look-ups are joins of two written tables, which adaptive execution can
split when one vertex has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import cut, drop


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): component is the smallest node reachable. Only nodes with an edge to another appear."""
    e = cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"), "edges")
    labels = None
    turn = 0
    while not e.isEmpty():
        turn += 1
        both = e.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(e.select(F.col("b").alias("v"), F.col("a").alias("w")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("v"))
        parent = both.groupBy("v").agg(F.min(rank(F.col("w"))).alias("m"))
        parent = cut(parent.select("v", F.least(F.col("m"), rank(F.col("v")))["v"].alias("p")), "parent")
        if labels is None:
            labels = cut(parent.select(F.col("v").alias("node"), F.col("p").alias("label")), "labels")
        else:
            old = labels
            labels = cut(old.join(parent, F.col("label") == F.col("v"), "left").select("node", F.coalesce("p", "label").alias("label")), "labels")
            drop(old)
        up = e.join(parent.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a").join(parent.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
        old = e
        e = cut(up.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        drop(old, parent)
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    least = cut(labels.groupBy("label").agg(F.min("node").alias("component")), "least")
    out = cut(labels.join(least, "label").select("node", "component"), "components")
    drop(labels, least, e)
    return out
