"""Connected components of a link table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, src: str, dst: str, max_rounds: int = 64) -> DataFrame:
    """``node, label``: every node of an undirected link table and the smallest node it reaches.

    Each round gives every node the smallest neighbour below itself as parent,
    follows parents to their roots, and replaces links by links between roots.
    Every node with a link joins another one, so at least half of the nodes
    vanish in a round.  All
    state lives in checkpointed tables; the driver only sees counts.  Nodes
    must not be null; self-links and repeated links are allowed.
    """
    edges = links.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u <> v").distinct().checkpoint()
    labels = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    labels = labels.select("node", F.col("node").alias("label")).checkpoint()
    for _ in range(max_rounds):
        if edges.isEmpty():
            return labels
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("p"))
        # every u has a row, and every parent is some u
        parent = parent.checkpoint()
        while True:  # to the roots: each turn doubles the steps up, until nothing moves
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jump = parent.join(up, "p").select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved"))
            jump = jump.checkpoint()
            parent = jump.select("u", "p")
            if jump.where("moved").isEmpty():
                break
        labels = (
            labels.join(parent, labels["label"] == parent["u"], "left")
            .select("node", F.coalesce("p", "label").alias("label"))
            .checkpoint()
        )
        one = edges.join(parent, "u").select(F.col("p").alias("a"), F.col("v").alias("u"))
        edges = one.join(parent, "u").select(F.col("a").alias("u"), F.col("p").alias("v"))
        edges = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct().checkpoint()
    raise RuntimeError("links left after the last round")
