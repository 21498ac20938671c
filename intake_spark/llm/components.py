"""Connected components of an edge table, by repeated contraction; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(a, b) bigints to (node, root): nodes have the same root exactly if they are connected. Nodes without an edge to another are left out.

    In each round every node hooks onto that of itself and its neighbours with the smallest hash of the round, and edges move to what their
    ends hook onto. A constant share of the nodes goes each round whatever the shape, so rounds grow with the logarithm of the input.
    """
    edges = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    hooks: list[DataFrame] = []
    while not edges.isEmpty():
        mark = lambda c: F.struct(F.xxhash64(F.lit(len(hooks)), c).alias("h"), F.col(c).alias("id"))
        both = edges.select(F.col("a").alias("node"), mark("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), mark("a").alias("other")))
        hook = both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("other", mark("node")).getField("id").alias("to"))
        hook = written(hook, "hooks")
        hooks.append(hook)
        moved = edges.join(hook.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a").join(hook.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        edges = written(moved.filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    if not hooks:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = hooks[0].select("node", F.col("to").alias("root"))
    for hook in hooks[1:]:
        roots = roots.join(hook.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return written(roots, "roots")
