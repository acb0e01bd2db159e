"""Connected components of an edge table, by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger neighbours (large) or its smaller ones and itself (small) to its smallest one."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v: long); root is the component's smallest node.

    Each round is two joins on a node and is written to scratch, so lineage
    stays short; rounds grow with the logarithm of the longest path.  The
    neighbours of one node are never gathered: only their minimum is, which
    combines before the shuffle, and Spark splits a skewed join side.  Repeated
    edges and loops change nothing, edges with a null end are left out, and so are nodes whose only
    edges are loops; an empty table gives no rows.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return common.stored(df.where("u != v").distinct(), "components")  # a null end is not unequal either

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    now = tidy(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    mark = state(now)
    while mark[0]:
        now = tidy(_star(_star(now, large=True).where("u != v").distinct(), large=False))
        after = state(now)
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
