"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is a pair of aggregations and joins over the links alone and is written to the shared
folder; links never reach the driver. Hubs are combined before the shuffle (minimum per node) and
the joins that follow are plain equi-joins, which AQE splits when a hub is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, uncompiled

MAX_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (a, b) with a > b. Tie each node's (larger, or smaller) neighbours to its least neighbour."""
    if large:
        near = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("u", "v")
    else:
        near = links.toDF("u", "v")
    least = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    tied = near.join(least, "u")
    if large:
        out = tied.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links: two long columns. Returns (node, label): every linked node with the least node it reaches."""
    a, b = (F.col(c) for c in links.columns[:2])
    now = staged(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links"
    )
    mark = None
    for _ in range(MAX_ROUNDS):
        with uncompiled(now.sparkSession):
            now = staged(_star(staged(_star(now, True), "large-star"), False), "small-star")
            new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    return now.toDF("node", "label").union(now.select("b", "b").distinct())
