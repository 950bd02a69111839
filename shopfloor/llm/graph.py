"""Connected components by contraction, as Spark joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm.common import Scratch


def connected_components(scratch: Scratch, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; a component is named by its smallest node.

    Every round each vertex hooks onto its smallest neighbour (pre-aggregated
    minimum, so a hub with a third of all edges costs one row per task), two
    pointer steps shorten the chains, and edges and labels move to the new
    vertices.  A hub's edges fall together in the first round; the edges shrink
    until none is left.  Self loops and repeated edges are harmless; edges with
    a null end are ignored.
    """
    edges = (edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
             .where((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct())
    edges = scratch.save(edges, "edges")
    both = edges.select(F.explode(F.array("a", "b")).alias("node"))
    labels = scratch.save(both.distinct().withColumn("component", F.col("node")), "labels")
    while edges.limit(1).count():
        sides = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = sides.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("p"))
        hook = scratch.save(hook, "hooks")
        up = hook.select(F.col("v").alias("p"), F.col("p").alias("top"))
        step = scratch.save(hook.join(up, "p", "left").select("v", F.coalesce("top", "p").alias("p")), "steps")
        new_labels = (labels.join(step, labels["component"] == step["v"], "left")
                      .select("node", F.coalesce("p", "component").alias("component")))
        new_labels = scratch.save(new_labels, "labels")
        to_a = step.select(F.col("v").alias("a"), F.col("p").alias("pa"))
        to_b = step.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        moved = (edges.join(to_a, "a").join(to_b, "b").where("pa <> pb")
                 .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        new_edges = scratch.save(moved, "edges")
        scratch.drop(edges, labels, hook, step)
        edges, labels = new_edges, new_labels
    scratch.drop(edges)
    return labels
