"""Connected components of a link table, by repeated contraction.

Each round every vertex points to its smallest neighbour (or itself) and the links
are redrawn between the vertices pointed to. Only vertices that are smaller than all
their neighbours stand still, so at least half of the linked vertices vanish in a
round and the rounds grow with the logarithm of the longest chain. Everything is an
aggregate (combined on the map side) or an equi-join; nothing is collected but one
count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimlake.llm.common import stage


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of ``links`` (columns a, b); the component
    is its smallest vertex. Repeated links, loops and null ends do no harm; a table
    without links gives no rows."""
    both = lambda e: e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = links.where("a != b")
    labels = None
    while labels is None or not edges.isEmpty():
        points = stage(spark, both(edges).groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("to")), "points")
        if labels is None:
            labels = points.select(F.col("a").alias("vertex"), F.col("to").alias("component"))
        else:
            moved = points.select(F.col("a").alias("component"), "to")
            labels = stage(spark, labels.join(moved, "component", "left").select("vertex", F.coalesce("to", "component").alias("component")), "labels")
        head = points.select("a", F.col("to").alias("x"))
        tail = points.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = stage(
            spark,
            edges.join(head, "a").join(tail, "b").where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
    return labels
