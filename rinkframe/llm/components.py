"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import storage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Label every node of the edges with the smallest node of its component: node, label."""
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = both.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    left = storage.table(both, "edges")
    nodes = left.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    labels = storage.table(nodes.withColumn("label", F.col("node")), "labels")
    while True:
        # Each label hooks onto the smallest label next to it, and follows that one's hook and the next.
        # Hooks point downwards, so every round joins labels until no edge lies between two.
        hooks = storage.table(left.groupBy("x").agg(F.min("y").alias("y")), "hooks")
        if not hooks.limit(1).count():
            return labels
        up = hooks.select(F.col("x").alias("m"), F.col("y").alias("z"))
        once = hooks.join(up, F.col("y") == F.col("m"), "left").select("x", F.coalesce("z", "y").alias("y"))
        twice = once.join(up, F.col("y") == F.col("m"), "left").select(F.col("x").alias("h"), F.coalesce("z", "y").alias("to"))
        to = storage.table(twice, "hooks")
        labels = storage.table(labels.join(to, F.col("label") == F.col("h"), "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        moved = left.join(to, F.col("x") == F.col("h"), "left").select(F.coalesce("to", "x").alias("x"), "y")
        moved = moved.join(to, F.col("y") == F.col("h"), "left").select("x", F.coalesce("to", "y").alias("y")).where("x <> y")
        left = storage.table(moved.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "edges")
