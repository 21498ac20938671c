"""Connected components by contraction, in a fixed number of rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import staged

#: Each round leaves at most about half of what is still connected.
ROUNDS = 4


def contracted(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """edges (a, b) bigints to (node, label, whole) of nodes that have edges to others: nodes of one label are connected, and where `whole` is true, the
    label is all of a component; what is longer than the rounds reach has several labels, none of them whole.

    In each round a node takes the label of itself or that neighbour which has the smallest hash of the round, and edges move to the new labels.
    """
    open_ = staged(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = open_.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    for n in range(rounds):
        mark = lambda c: F.struct(F.xxhash64(F.lit(n), c).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        both = open_.select(F.col("a").alias("label"), mark("b").alias("other")).unionByName(open_.select(F.col("b").alias("label"), mark("a").alias("other")))
        hook = staged(both.groupBy("label").agg(F.min("other").alias("other")).select("label", F.least("other", mark("label"))["id"].alias("to")), "hooks")
        labels = labels.join(hook, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        end = lambda c: hook.select(F.col("label").alias(c), F.col("to").alias(f"to_{c}"))  # noqa: B023, E731
        moved = open_.join(end("a"), "a").join(end("b"), "b").filter("to_a <> to_b")
        open_ = staged(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    left = open_.select(F.explode(F.array("a", "b")).alias("label")).distinct().withColumn("_left", F.lit(True))
    return labels.join(left, "label", "left").select("node", "label", F.col("_left").isNull().alias("whole"))
