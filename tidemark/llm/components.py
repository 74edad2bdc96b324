"""Connected components by label propagation with pointer jumping.

Every step is a join of written tables, so AQE may split a node with very many
edges, followed by a partially aggregated minimum. Labels never leave Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, component): the smallest node reachable. Nodes
    without edges do not occur."""
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = materialize(both, "cc-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "cc-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = materialize(labels.join(near, "node").select("node", F.least("component", "near").alias("component"), (F.col("near") < F.col("component")).alias("changed")), "cc-hooked")
        if hooked.where("changed").isEmpty():
            return hooked.drop("changed")
        to = hooked.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = materialize(hooked.drop("changed").join(to, "component").select("node", F.col("further").alias("component")), "cc-labels")
