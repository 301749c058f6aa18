"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs); root is the smallest node reachable.

    Edges point from the larger to the smaller node. A round first moves every
    edge's lower end to that node's own smallest neighbour, then links all
    lower ends of a node to the smallest of them; it ends when each node has
    one edge and no lower end has an edge itself. Each round is staged in the
    shared folder, and the minima are staged before they are joined, so that a
    hub's rows can be split between tasks. Nothing is collected but counts.
    An empty table gives an empty table; loops and repeated edges are ignored.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = staged(e, "components")
    while True:
        low = staged(e.groupBy("u").agg(F.min("v").alias("m")), "components")
        hops = low.withColumnRenamed("u", "v")
        if e.count() == low.count() and e.join(hops, "v", "left_semi").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        e = staged(e.join(hops, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct(), "components")
        low = staged(e.groupBy("u").agg(F.min("v").alias("m")), "components")
        linked = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(linked.union(low.select("u", "m")).distinct(), "components")
