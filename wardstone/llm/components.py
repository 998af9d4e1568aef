"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is two aggregations and joins over links; a node's neighbours are
never gathered, only their minimum. Rounds are written to the shared folder, so
that a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstone.session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hook each node's neighbours (the larger ones, or the smaller ones and itself) to their minimum."""
    if large:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        hooked = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        below = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        hooked = below.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hooked.where("a <> b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (src, dst); the component is its smallest node.

    Links may repeat and point either way. Links of a node to itself and links with a null end are ignored.
    """
    now = materialize(
        links.where("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct(), "links"
    )
    mark = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        now = materialize(_star(_star(now, True), False), "links")
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
