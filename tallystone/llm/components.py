"""Connected components of a table of links, by smallest labels and label jumping.

Each round every node takes the smallest label among its own and its neighbours', then the label of its label. Labels
move twice as far in each round. All steps are joins and partial aggregations over shared storage; a node with very
many links is a skewed join key, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.session import materialize


def components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """links: a, b. node and label (the smallest node of its component) of all nodes with links. Nulls are no nodes."""
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("jumped"))
        step = step.join(jump, "label").select("node", "old", F.least("label", "jumped").alias("label"))
        step = materialize(step, "labels")
        labels = step.select("node", "label")
        if step.where("old != label").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
