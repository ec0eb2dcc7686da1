"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage


def connected_components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """``node``, ``label`` for every node of ``edges`` (``a``, ``b``); the label is the component's smallest node.

    Each round hangs every node under the smallest label of its neighbours and then
    follows the labels one step further, so the number of rounds grows with the
    logarithm of a component's diameter. All steps are joins and minima that are
    combined before they move; each round is written, so no lineage builds up and a
    lost executor repeats one round. Null ends and loops are left out.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stage(edges.distinct(), "component-edges")
    done = None
    for _ in range(rounds):
        # The smallest neighbour of every node, itself included.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
        # One step further: the smallest neighbour's own smallest neighbour.
        further = low.select(F.col("node").alias("low"), F.col("low").alias("label"))
        low = stage(low.join(further, "low").select("node", F.least("low", "label").alias("label")), "component-labels")
        done = low if done is None else _followed(done, low)
        # Edges between labels remain; an edge inside one label is settled.
        by_a = low.select(F.col("node").alias("a"), F.col("label").alias("la"))
        by_b = low.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        left = edges.join(by_a, "a").join(by_b, "b").where("la <> lb")
        # A label that was itself moved keeps its edge to where it went.
        moved = low.join(low.select(F.col("node").alias("label"), F.col("label").alias("top")), "label").where("label <> top")
        left = left.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).unionByName(
            moved.select(F.col("top").alias("a"), F.col("label").alias("b"))
        )
        edges = stage(left.distinct(), "component-edges")
        if edges.isEmpty():
            return done
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _followed(done: DataFrame, low: DataFrame) -> DataFrame:
    """Earlier labels, replaced where they moved in this round."""
    step = low.select(F.col("node").alias("label"), F.col("label").alias("next"))
    joined = done.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return stage(joined, "component-labels")
