"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b``: the root is the least node that links lead to.

    Alternates two steps on the links until they are stars around their roots: each node
    hands its larger neighbours to its least one, then its smaller ones. A hub's
    neighbours stay separate rows throughout, and the least one is found by a partial
    aggregate, so no node's neighbours need to meet in a task.
    """

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))

    def mark(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        before = edges
        around = edges.select(both_of("u", "v").alias("e")).select("e.*")
        large = around.join(least(around), "u").select("v", F.least("u", "m").alias("m"), "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(least(large), "u")
        edges = stage(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(small.select("u", F.col("m").alias("v"))).distinct()
        )
        if mark(before) == mark(edges):
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select("v", "v").distinct().toDF("node", "root"))


def both_of(one: str, two: str):
    return F.explode(F.array(F.struct(F.col(one).alias("u"), F.col(two).alias("v")), F.struct(F.col(two).alias("u"), F.col(one).alias("v"))))
