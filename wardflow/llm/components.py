"""Connected components of an edge table, by pointers to smaller nodes and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.operators.ordering import stage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; a component is its smallest node.

    Each round every node points to its smallest neighbour, if that is smaller; pointers are
    followed to their ends, and edges are kept between these ends only. So a round leaves
    half of the nodes at most, and of a star no edge. What a round found is written: none
    depends on an executor that ran an earlier one, and both sides of each join are plain
    scans, so adaptive execution can split a node with many edges.
    """
    left = stage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = left.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    first = True
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        ends = _followed(stage(lowest.select("node", F.least("node", "low").alias("component"))))
        labels = ends if first else stage(_renamed(labels, "component", ends))
        first = False
        kept = _renamed(_renamed(left, "a", ends), "b", ends).filter("a <> b")
        left = stage(kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels


def _renamed(df: DataFrame, column: str, ends: DataFrame) -> DataFrame:
    """``df`` with the values of ``column`` replaced by where they lead to, if anywhere."""
    to = ends.select(F.col("node").alias("_node"), F.col("component").alias("_end"))
    joined = df.join(to, df[column] == to["_node"], "left")
    return joined.select(*[F.coalesce("_end", c).alias(c) if c == column else F.col(c) for c in df.columns])


def _followed(pointers: DataFrame) -> DataFrame:
    """Pointers to smaller nodes, each replaced by the end of its chain."""
    while True:
        via = pointers.select(F.col("node").alias("_node"), F.col("component").alias("_next"))
        longer = stage(pointers.join(via, pointers["component"] == via["_node"]).select("node", "component", "_next"))
        pointers = longer.select("node", F.col("_next").alias("component"))
        if longer.filter("component <> _next").isEmpty():
            return pointers
