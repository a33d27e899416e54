"""Connected components as joins over written tables; no links or labels reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge; label is the least node reachable.

    Each round takes the least label around a node and then that label's own label,
    so chains shrink by half a round. Loops, repeated edges and an empty table are fine;
    edges with a null end are ignored.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    both = written(e.union(e.select("v", "u")).distinct(), "edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")), "labels")
    while True:
        around = both.join(labels, both.v == labels.node).groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(around, "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("old"))
        ahead = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        moved = written(lower.join(ahead, "next").select("node", F.least("next", "jump").alias("label"), "old"), "labels")
        discard(labels)
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            discard(both)
            return labels
