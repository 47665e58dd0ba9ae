"""Connected components by distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b); the root is the smallest node reached.

    Each round hangs every node under its smallest neighbour, or itself, and contracts the
    edges to the parents; a component shrinks to its smallest node in about as many rounds
    as the logarithm of its width. Neighbours are folded by partial aggregates, never
    collected, and joins on a node with many edges are split by adaptive execution.
    Repeated edges and loops change nothing; no edges give no rows.
    """
    pairs = cut_lineage(edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct())
    labels = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    labels = cut_lineage(labels)
    pairs = pairs.where("a <> b")
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("least"))
        parents = cut_lineage(parents.select(F.col("a").alias("child"), F.least("a", "least").alias("parent")))
        labels = cut_lineage(
            labels.join(parents, F.col("root") == F.col("child"), "left").select("node", F.coalesce("parent", "root").alias("root"))
        )
        left = pairs.join(parents, F.col("a") == F.col("child")).select(F.col("parent").alias("a"), "b")
        moved = left.join(parents, F.col("b") == F.col("child")).select("a", F.col("parent").alias("b"))
        pairs = cut_lineage(moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels
