"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoframe.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every end of ``edges(a, b)``; both of one ordered type.

    Edges with a null end and loops link nothing; repeated edges count once; no edges give no rows. Each round hangs
    neighbours on their smallest neighbour, in logarithmically many rounds at most squared, until all edges lead from a leaf to
    a root. Every round's edges and minima are written tables, so the joins read plain exchanges whose hot keys Spark
    can split; nothing is collected but counts.
    """
    e = scratch.put(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    for _ in range(max_rounds):
        if _settled(e):
            break
        both = e.unionByName(e.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = scratch.put(both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m")), "low")
        large = scratch.put(both.join(low, "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct(), "large")
        scratch.drop(low)
        low = scratch.put(large.groupBy("v").agg(F.min("u").alias("m")), "low")
        hung = large.join(low, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        new = scratch.put(hung.unionByName(low.withColumnRenamed("m", "u")).distinct(), "edges")
        scratch.drop(low, large, e)
        e = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(e.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct())


def _settled(e: DataFrame) -> bool:
    """Whether every edge leads from a leaf that has no other edge to a root: no end is twice a leaf, none is both."""
    ends = e.select(F.col("v").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).unionByName(e.select(F.col("u").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
    return ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root")).where("leaf > 1 OR (leaf = 1 AND root = 1)").isEmpty()


def extended(found: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``found(id, component)`` after more ``links(a, b)``: only the graph of the components that they join is solved."""
    ends = links
    for end in "ab":
        ends = ends.join(found.select(F.col("id").alias(end), F.col("component").alias(f"in_{end}")), end, "left")
    joined = scratch.put(ends.select(F.coalesce("in_a", "a").alias("a"), F.coalesce("in_b", "b").alias("b")).where("a <> b").distinct(), "joined")
    if joined.isEmpty():
        return found
    top = scratch.put(connected_components(joined, scratch), "top")
    moved = found.join(top.select(F.col("id").alias("component"), F.col("component").alias("under")), "component", "left").select("id", F.coalesce("under", "component").alias("component"))
    return scratch.put(moved.unionByName(top.join(found.select("id"), "id", "left_anti").select("id", "component")), "components")
