"""Connected components of an edge table, in Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``edges`` (a, b: long).

    Each node hooks to its smallest neighbour if that is smaller, pointers are
    doubled until they reach their roots, and the edges between different roots
    are contracted into the next round. Nodes that no edge changes are not moved.
    """
    links = materialise(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    labels = None
    while not links.isEmpty():
        roots = _doubled(links.groupBy("a").agg(F.min("b").alias("b")))
        to = roots.select(F.col("a").alias("x"), F.col("b").alias("r"))
        if labels is None:
            nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
            moved = nodes.join(to, nodes.node == to.x, "left").select("node", F.coalesce("r", "node").alias("root"))
        else:
            moved = labels.join(to, labels.root == to.x, "left").select("node", F.coalesce("r", "root").alias("root"))
        labels = materialise(moved, "labels")
        left = links.join(to, links.a == to.x, "left").select(F.coalesce("r", "a").alias("a"), "b")
        both = left.join(to, left.b == to.x, "left").select("a", F.coalesce("r", "b").alias("b")).where("a != b")
        links = materialise(
            both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
        )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).where(F.lit(False))
    return labels


def _doubled(parents: DataFrame) -> DataFrame:
    """a, b with b the root that a's chain of parents ends in."""
    held = materialise(parents, "parents")
    while True:
        up = held.select(F.col("a").alias("x"), F.col("b").alias("y"))
        jumped = materialise(
            held.join(up, held.b == up.x, "left").select("a", F.coalesce("y", "b").alias("b"), F.col("y").isNotNull().alias("far")),
            "parents",
        )
        if jumped.where("far").isEmpty():
            return jumped.drop("far")
        held = jumped.drop("far")
