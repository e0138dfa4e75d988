"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every end of an edge ``(a, b)``; the component is its smallest node.

    In each round a node points to its smallest neighbour (or stays), pointers are followed to their roots, and the
    edges between different roots go on. Every step is a keyed aggregate or an equi join of one row per node or edge.
    """
    edges = staged(edges.where("a <> b").select("a", "b").distinct(), "links")
    known = None
    while True:
        both = edges.union(edges.select("b", "a"))
        up = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")), "link-parents")
        while True:
            jumped = staged(up.alias("u").join(up.alias("v"), F.col("u.to") == F.col("v.a"))
                            .select("u.a", F.col("v.to").alias("to"), (F.col("u.to") != F.col("v.to")).alias("moved")), "link-parents")
            up = jumped.select("a", "to")
            if jumped.where("moved").isEmpty():
                break
        if known is None:
            known = up.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            known = staged(known.join(up, known["component"] == up["a"], "left")
                           .select("node", F.coalesce("to", "component").alias("component")), "link-components")
        left, right = up.select(F.col("a"), F.col("to").alias("x")), up.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = staged(edges.join(left, "a").join(right, "b").where("x <> y")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return known
