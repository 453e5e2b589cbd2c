"""Connected components of a distributed edge list by contraction.

Each round every node points at its least neighbour, pointers are followed twice, and the edges
are rewritten to the pointed-at nodes; edges inside one node vanish. Every round's tables are
written to the shared folder, so an executor may be lost at any time. Only the number of edges
left comes to the driver. Group keys are pre-aggregated minima, so a node with any number of
edges costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmodel.llm import scratch


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b: bigint); root is the least node reachable."""
    edges = scratch.written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("p"))
        point = point.select("node", F.least("node", "p").alias("p"))
        step = point.select(F.col("node").alias("p"), F.col("p").alias("q"))
        point = scratch.written(point.join(step, "p").select("node", F.col("q").alias("p")), "pointers")
        if labels is None:
            labels = point.select("node", F.col("p").alias("root"))
        else:
            moved = labels.join(point.select(F.col("node").alias("root"), "p"), "root", "left")
            labels = scratch.written(moved.select("node", F.coalesce("p", "root").alias("root")), "labels")
        left = edges.join(point.select(F.col("node").alias("a"), F.col("p").alias("pa")), "a")
        left = left.join(point.select(F.col("node").alias("b"), F.col("p").alias("pb")), "b")
        left = left.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).where("a <> b").distinct()
        edges = scratch.written(left, "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
