"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.common import saved


def _roots(parents: DataFrame) -> DataFrame:
    """(node, label): the end of each chain of parents, found by doubling.

    Parents are smaller than their nodes, so the chains end; each step halves
    what is left of them."""
    steps = parents.select("node", F.col("parent").alias("label"), F.lit(True).alias("moved"))
    while True:
        up = steps.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        steps = saved(
            steps.drop("moved")
            .join(up, "label", "left")
            .select(
                "node",
                F.coalesce("_next", "label").alias("label"),
                F.col("_next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if steps.filter("moved").isEmpty():
            return steps.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; label is the smallest node of
    its component. ``edges`` has two long columns, a and b.

    Each round hangs every node below its smallest neighbour, shortens those
    trees to their roots and keeps only the edges between roots. A node of many
    edges sends one partial minimum per input partition. Nothing but an emptiness
    test reaches the driver. An empty edge table gives an empty result."""
    live = saved(
        edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges",
    )
    labels = None
    while not live.isEmpty():
        # only nodes with a smaller neighbour get a parent; the others are roots
        parents = live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        roots = _roots(parents)
        at = lambda c: roots.select(F.col("node").alias(c), F.col("label").alias(f"_{c}"))
        step = (
            live.join(at("a"), "a", "left").join(at("b"), "b", "left")
            .select(F.coalesce("_a", "a").alias("x"), F.coalesce("_b", "b").alias("y"))
        )
        live = saved(
            step.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
        if labels is None:
            labels = roots
        else:
            moved = roots.select(F.col("node").alias("label"), F.col("label").alias("_to"))
            kept = labels.join(moved, "label", "left").select("node", F.coalesce("_to", "label").alias("label"))
            labels = saved(kept.unionByName(roots), "labels")
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("label"))
    own = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.unionByName(own).distinct()
