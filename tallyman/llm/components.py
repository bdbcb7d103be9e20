"""Connected components of a distributed edge list, by contraction.

Each round every node points to its least neighbour (or itself), pointers are
followed once more, and the edges move to where their ends point; edges inside
one node vanish.  With node ids that are hashes, hence in random order, the
number of nodes falls by a constant factor a round.  Every round is written to
the shared folder, so lineage stays short and a lost executor costs one round.
Nothing is collected but whether edges remain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import forget, written


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every end of an edge (a, b); component is some node of it, the same for all its nodes."""
    edges = written(edges.select("a", "b").where(F.col("a") != F.col("b")), f"{label}-edges")
    labels = None
    while edges.limit(1).count():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("to"))
        least = written(least, f"{label}-least")
        far = least.select(F.col("node").alias("to"), F.col("to").alias("far"))
        points = written(least.join(far, "to").select("node", F.col("far").alias("to")), f"{label}-points")
        old = (edges, least, points, labels)
        if labels is None:
            labels = points.select("node", F.col("to").alias("component"))
        else:
            moved = points.select(F.col("node").alias("component"), "to")
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = written(labels, f"{label}-labels")
        left = edges.join(points.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").select("b", "x")
        both = left.join(points.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges = written(both.where(F.col("x") != F.col("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{label}-edges")
        forget(*old)
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
