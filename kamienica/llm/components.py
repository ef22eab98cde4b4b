"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kamienica.session import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; the root is the smallest node of the component.

    `edges` (u, v) is a written table. Each step hangs the neighbours of every node to the least of them, first the
    greater ones, then the smaller; the edges end as stars. Steps grow with the logarithm of the number of nodes; every
    step is written, so a lost executor repeats one step at most.
    """
    edges = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
                 .where("u <> v").distinct())
        large = settle(large)
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("least").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("least").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct())
        edges = settle(small)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
