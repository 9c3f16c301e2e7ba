"""Connected components of a graph of rows, for near-duplicate groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the smallest node of its component.

    Each round takes over the smallest label among neighbours, hands it to the
    label's own node, and jumps one label ahead, so the number of rounds grows
    with the logarithm of a component's width. Every step is a join or a
    summed-up aggregation on node ids; nothing is gathered by component. Each
    round's table is written to the shared folder; the last one is returned, a
    stored table that the caller may discard. No edges, no rows.
    """
    both = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                  .union(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).where("u <> v").distinct(), "edges")
    labels = stored(both.groupBy("u").agg(F.min("v").alias("v"))
                    .select(F.col("u").alias("node"), F.least("u", "v").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "root"), "v").groupBy("u").agg(F.min("root").alias("near")) \
            .withColumnRenamed("u", "node")
        met = labels.select("node", "root").join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        hooked = met.groupBy("root").agg(F.min("low").alias("hook"))
        step = stored(met.join(hooked, "root").select(
            "node", F.col("root").alias("was"), F.least("low", "hook").alias("root")), "labels")
        ahead = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        discard(labels)
        jumped = stored(step.join(ahead, "root", "left").select(
            "node", "was", F.least("root", F.coalesce("next", "root")).alias("root")), "labels")
        discard(step)
        labels = jumped
        if not jumped.where("root <> was").limit(1).count():
            discard(both)
            return labels
