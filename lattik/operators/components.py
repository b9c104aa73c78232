"""Connected components of a link table, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattik.operators.closure import MOST_ROUNDS, cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``label`` (the smallest node of its component) of all nodes that have a link.

    Each round joins every node to the smallest neighbour that it knows of, then halves the stars' depth by joining labels
    with their own labels. State is one row a node besides the links; joins are on nodes, so adaptive execution splits hubs.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    both = cut(both.union(both.select("y", "x")).distinct())
    state = cut(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).withColumnRenamed("x", "node"))
    for _ in range(MOST_ROUNDS):
        near = both.join(state.select(F.col("node").alias("y"), "label"), "y").groupBy(F.col("x").alias("node")).agg(F.min("label").alias("least"))
        lower = state.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        # a label's own label, and what the old label's holders found, are taken over
        found = lower.groupBy(F.col("old").alias("label")).agg(F.min("label").alias("best"))
        after = lower.join(found, lower["old"] == found["label"], "left").select("node", "old", F.least(lower["label"], F.col("best")).alias("label"))
        after = cut(after)
        if after.where("label <> old").isEmpty():
            return after.select("node", "label")
        state = after.select("node", "label")
    raise RuntimeError(f"no fixpoint after {MOST_ROUNDS} rounds")
