"""Connected components by alternating stars, in a number of rounds that grows with the logarithm of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingstrata.operators.joins import splittable_join
from filingstrata.sources.staging import stage


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): the root is the least node that links reach.

    Large star: each node hands its greater neighbours to the least node it knows. Small star: each
    node hands itself and its lesser neighbours to the least of them. Both keep the components; when
    nothing changes, all nodes hang on their least one. Joins back to a node's least neighbour can be
    split, so a node with a third of all edges does no harm. Loops and nulls are left out.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u is not null and v is not null and u <> v")
    now = stage(now.distinct(), "links")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = splittable_join(both, least, ["u"], "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = splittable_join(large, least, ["u"], "inner").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
