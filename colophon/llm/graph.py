"""Connected components of links that stay on the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colophon.llm.common import ensure_checkpoint_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)``: the smallest node each node of ``links`` reaches.

    First every node is linked to the least of its smaller neighbours, and so are these, in place of
    its own links to them: what is dense becomes a star. Then labels take the least label among
    neighbours, then jump to their label's label, so rounds grow
    with the logarithm of a component's diameter. Every round is checkpointed in the shared folder.
    Null ends, loops and repeated links change nothing; without links the result is empty.
    """
    ensure_checkpoint_dir(links.sparkSession)
    pairs = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter("src <> dst")
    pairs = pairs.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    stars = pairs.withColumn("least", F.min("dst").over(Window.partitionBy("src")))
    stars = stars.select(F.explode(F.array("src", "dst")).alias("src"), F.col("least").alias("dst")).filter("src <> dst").distinct()
    edges = stars.union(stars.select("dst", "src")).checkpoint()
    labels = edges.groupBy("src").agg(F.min("dst").alias("least"))
    labels = labels.select(F.col("src").alias("node"), F.least("src", "least").alias("component")).checkpoint()
    while True:
        said = edges.join(labels.select(F.col("node").alias("dst"), "component"), "dst")
        said = said.groupBy("src").agg(F.min("component").alias("heard"))
        near = labels.join(said, labels["node"] == said["src"]).select(
            "node", F.col("component").alias("old"), F.least("component", "heard").alias("new")
        )
        roots = labels.select(F.col("node").alias("new"), F.col("component").alias("root"))
        jumped = near.join(roots, "new").select("node", "old", F.least("new", "root").alias("component")).checkpoint()
        labels = jumped.select("node", "component")
        if jumped.filter("old <> component").isEmpty():
            return labels


def least_reached(linked: np.ndarray) -> np.ndarray:
    """For each row of a square, symmetric matrix the least row it reaches by links."""
    least = np.arange(len(linked))
    changed = len(linked) > 1
    while changed:
        changed = False
        for a in range(0, len(linked), 256):
            here = np.where(linked[a : a + 256], least, len(linked)).min(axis=1, initial=len(linked))
            new = np.minimum(least[a : a + 256], here)
            new = np.minimum(new, least[new])
            if (new < least[a : a + 256]).any():
                least[a : a + 256] = new
                changed = True
    return least
