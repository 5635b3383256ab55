"""Connected components of a graph of links, by alternating large-star and small-star rounds.

Each round is two grouped minima and joins on the node, so a node with very many links is
reduced on the map side and split by the skew join.  Rounds are written to the shared folder;
they end when no link changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(links: DataFrame) -> DataFrame:
    near = _both_ways(links)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where("v > u").join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows node, root: each linked node with the least node that it reaches; links have columns u and v."""
    known = materialize(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(known)
    while before[0]:
        known = materialize(_small_star(_large_star(known)), "star")
        after = mark(known)
        if after == before:
            break
        before = after
    stars = known.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
