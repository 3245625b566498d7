"""Connected components of edge lists, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vialis.llm.common import discard, written


def _state(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the component's least node.

    Each round joins every node's larger neighbours to its least neighbour, then
    its smaller ones; the minimum is counted in the tasks first, and a hub's
    edges stay rows of a join that Spark can split. After a number of rounds that
    grows with the logarithm of the longest path all edges end at the roots.
    Edges from a node to itself make it a component.
    """
    loops = edges.filter("a = b").select(F.col("a").alias("node")).distinct()
    current = written(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(lower.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        before, current = current, written(small, "edges")
        discard(before)
        after = _state(current)
        if after == state:
            break
        state = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    found = current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
    alone = loops.join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"))
    out = written(found.unionByName(alone), "components")
    discard(current)
    return out
