"""Connected components of a graph given as a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _stars(links: DataFrame) -> DataFrame:
    """One round. Large stars: every node hands its larger neighbours to the least node it knows.
    Small stars: every node hands its smaller neighbours, and itself, to the least of them."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = (both.where("b > a").join(least, "a").where("b <> m").select(F.col("m").alias("a"), "b").distinct())
    down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))  # a > b
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    handed = down.join(least, "a").where("b <> m").select(F.col("m").alias("a"), "b")
    return handed.unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (its component's smallest node) for every node that has a link.

    Nodes are integers; links to itself, repeated links and links with a null are ignored. Every
    round is written to the shared folder and costs a few joins by node; hubs are summed
    before they are shuffled and split by Spark where they are joined."""
    links = (links.select(F.least(a, b).cast("long").alias("a"), F.greatest(a, b).cast("long").alias("b"), F.col(a).alias("_x"), F.col(b).alias("_y"))
             .where("_x <> _y").select("a", "b").distinct())
    now, before = materialize(links, "links"), None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == before or not seen[0]:
            break
        before = tuple(seen)
        now = materialize(_stars(now), "links")
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
