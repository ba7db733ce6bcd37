"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.llm.common import stored


def _change(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the component's smallest node) of every node of the edge list (u, v); loops and repeats are no matter.

    Large-star and small-star steps in turn: each node's larger neighbours, and
    then its smaller ones, are linked to its least neighbour, until nothing
    changes and every component is a star.  Each step is an aggregate (combined
    before its shuffle) and a join, which Spark splits where one node has very
    many neighbours.  Edges are stored after each round; none are collected.
    """
    e = stored(edges.select("u", "v").filter("u != v").distinct(), "edges")
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.*").filter("u != v").distinct())
        e = stored(small, "edges")
        now = _change(e)
        if now == last:
            break
        last = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
