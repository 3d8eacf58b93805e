"""Connected components of an edge table, as rounds of Spark joins.

Every round gives each node the smallest label among its neighbours and then
the label of that label (pointer jumping), writes the labels to the shared
folder and stops when no label changes. Labels and edges stay distributed;
only the count of changed rows comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` for every node of ``edges (a, b)``; root is its component's smallest id."""
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
        step = labels.join(near, "id").select("id", "root", F.least("root", "near").alias("low"))
        up = labels.select(F.col("id").alias("low"), F.col("root").alias("up"))
        after = step.join(up, "low").select("id", F.col("root").alias("old"), F.least("low", "up").alias("root"))
        after = materialize(after, "labels")
        changed = after.where(F.col("old") != F.col("root")).limit(1).count()
        labels = after.select("id", "root")
        if not changed:
            return labels
