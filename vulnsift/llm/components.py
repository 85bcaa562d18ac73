"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnsift.llm.common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b); comp is the least node reachable.

    Each round a node takes the least label among its neighbours and itself, then
    the label of that label. Rounds end when no label changes.
    """
    links = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    edges = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("now"))
        up = labels.select(F.col("node").alias("now"), F.col("comp").alias("jump"))
        step = stored(moved.join(up, "now", "left").select("node", "was", F.least("now", "jump").alias("comp")), "labels")
        changed = not step.where("was <> comp").isEmpty()
        labels = step.select("node", "comp")
        if not changed:
            return labels
