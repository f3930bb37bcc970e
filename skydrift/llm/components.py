"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skydrift.llm.tables import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u, v). Large: each neighbour above u is linked to the least of u
    and its neighbours; small: each neighbour below u, and u, to the least."""
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")) \
        .select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); the root is the least
    node of the component. Null ends and loops are ignored; an empty table of
    links gives an empty result.

    Each round is a few map-side combined groupings and equi-joins; the links
    never reach the driver, only their number and a checksum do."""
    links = written(links.select("u", "v").filter("u <> v").distinct(), "links")
    mark = None
    while True:
        links = written(_star(_star(links, True), False), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .union(links.select(F.col("v"), F.col("v")).distinct())
