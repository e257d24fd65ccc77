"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join on one end of the links. A step's result is a
written table in the shared folder, so neither lineage nor memory grows with the rounds; no
table of links is broadcast, however small its file.
The links end as stars around the smallest id of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.sources.shared import discard, materialize


def _stars(near: DataFrame, keep) -> DataFrame:
    """Every kept neighbour of a node is tied to the node's smallest neighbour or itself."""
    least = near.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
    return near.where(keep).join(least.hint("merge"), "a")


def components(links: DataFrame) -> DataFrame:
    """id and component (smallest id) of every id in `links`, a table of pairs a, b."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialize(links.where("a <> b").distinct(), "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _stars(both, F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        # The node itself joins its smallest neighbour too.
        small = _stars(large, F.lit(True))
        small = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        before, links = links, materialize(small.where("a <> b").distinct(), "links")
        discard(before)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    stars = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    centres = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
