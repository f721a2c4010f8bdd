"""Connected components of an undirected graph given as edges, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (columns a and b); component is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so the
    number of rounds follows the logarithm of a chain's length. Labels of a round are written to the
    shared folder; a hub's neighbours are reduced by partial minima before the shuffle.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialise(both, "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("other")).select("node", F.least("node", "other").alias("component")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        taken = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        roots = labels.select(F.col("node").alias("mid"), F.col("component").alias("root"))
        step = taken.join(roots, "mid").select("node", F.least("mid", "root").alias("component"), (F.least("mid", "root") != F.col("old")).alias("moved"))
        written = materialise(step, "labels")
        labels = written.select("node", "component")
        if written.where("moved").limit(1).isEmpty():
            return labels
