"""Connected components of a table of links, by alternating stars.

A round replaces each node's links by links to its least neighbour: first for neighbours above the node (large star),
then for neighbours below it (small star). The links become stars around each component's least node, after a number of rounds that
grows with the logarithm of the longest chain. Each round is written to the shared folder; a node's links are never gathered in one task:
the least neighbour is an aggregate, joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: u > v, distinct."""
    around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    joined = around.join(least, around.u == least.c)
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return moved.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root for each node that has a link; links: u and v, any order. The root is the least node."""
    now = materialise(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    while True:
        after = materialise(_star(_star(now, True), False))
        new = _mark(after)
        release(now)
        now = after
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = new
