"""Connected components of an edge table, in Spark, with every round stored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, a: str = "a", b: str = "b", keep=lambda t: t.checkpoint()) -> DataFrame:
    """(node, label): the smallest node of each component, for every node with an edge to another node.

    Alternating large and small stars: each round replaces edges by stars around smaller nodes. A round is
    two grouped minima and two joins; hot nodes are reduced before the shuffle (partial minimum) and split by
    the skew join. The rounds grow with the logarithm of the number of nodes. ``keep``
    stores the edges of a round."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    e = keep(e)
    before = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        e = keep(down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.shiftrightunsigned(F.xxhash64("u", "v"), 32)),
                    F.sum(F.shiftrightunsigned(F.xxhash64("v", "u", F.lit(1)), 32))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now
