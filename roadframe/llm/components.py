"""Connected components of an edge table by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadframe.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` long edges to ``(node, component)``, the smallest node of
    the component, for every node that has an edge.

    Each round takes the smallest label among a node's neighbours (a partial
    aggregate, so a hub costs a row per task) and then jumps to that label's
    own label; every round is stored in the shared folder. Stops when no
    label moves.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("l")).withColumnRenamed("a", "node"),
                    "cc-labels")
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("l").alias("m"))
        lower = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", "l", F.least("l", "m").alias("m"))
        jump = labels.select(F.col("node").alias("m"), F.col("l").alias("j"))
        following = stored(lower.join(jump, "m", "left").select(
            "node", F.least("m", F.coalesce("j", "m")).alias("l"), (F.col("l") != F.least("m", "j")).alias("moved")),
            "cc-labels")
        if following.where("moved").isEmpty():
            return following.select("node", F.col("l").alias("component"))
        labels = following.drop("moved")
