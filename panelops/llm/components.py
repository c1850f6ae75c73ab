"""Connected components of a table of edges, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.staging import stage_table


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "labels") -> DataFrame:
    """(node, label) of every node of an edge, the label being the smallest node reachable.

    Every step takes the least label of a node and its neighbours, adds it up map-side, and then follows
    labels once, so long chains need few steps. Each step is written to the shared folder.
    """
    both = stage_table(edges.select(F.col(a).alias("node"), F.col(b).alias("next")).union(
        edges.select(F.col(b).alias("node"), F.col(a).alias("next"))).distinct(), f"{name}-edges")
    labels = stage_table(both.groupBy("node").agg(F.min("next").alias("label")).select("node", F.least("node", "label").alias("label")), name)
    while True:
        near = both.join(labels.select(F.col("node").alias("next"), "label"), "next").groupBy("node").agg(F.min("label").alias("near"))
        hop = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        found = labels.join(near, "node").join(hop, "label").select(
            "node", F.least("label", "near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved"))
        done = stage_table(found, name)
        labels = done.select("node", "label")
        if done.filter("moved").isEmpty():
            return labels
