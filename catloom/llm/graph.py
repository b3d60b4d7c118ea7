"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catloom.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest member) of every node of ``edges`` (a, b: long).

    Each round every node joins its smallest neighbour and edges are redrawn between
    what they joined; rounds end when no edge is left. Loops and repeated edges do
    not matter. All tables between rounds are kept in the shared folder.
    """
    edges = keep(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        joined = keep(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to")), "joined")
        if labels is None:
            labels = joined.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            labels = labels.join(joined, labels.component == joined.a, "left").select(
                "node", F.coalesce("to", "component").alias("component")
            )
        labels = keep(labels, "labels")
        left = joined.toDF("a", "x")
        right = joined.toDF("b", "y")
        edges = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = keep(edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
