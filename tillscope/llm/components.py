"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.stored import stored


def _directed(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.where("a <> b").select(low, high).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``: the least node of its component.

    Each round hooks every node to its least neighbour, follows that once more, and keeps the edges between what is left,
    so long chains shrink by a factor each round. All tables live in the shared folder.
    """
    edges = stored(_directed(edges))
    roots = stored(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")))
    while not edges.isEmpty():
        ends = edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
            edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
        )
        hooked = stored(ends.groupBy("node").agg(F.min("root").alias("root")))
        beyond = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        parent = stored(hooked.join(beyond, "root").select("node", F.col("next").alias("parent")))
        up = parent.select(F.col("node").alias("root"), "parent")
        roots = stored(roots.join(up, "root", "left").select("node", F.coalesce("parent", "root").alias("root")))
        of_a = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = edges.join(of_a, "a").join(of_b, "b").select(F.col("pa").alias("a"), F.col("pb").alias("b"))
        edges = stored(_directed(moved))
    return roots
