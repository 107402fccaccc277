"""Connected components of a link table by alternating large and small stars.

Every round replaces the links by links to smaller nodes (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014) until nothing changes.
Only aggregates and joins on the links; each round is cut by ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.session import checkpoint_dir


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; root: smallest node of its component.

    ``links``: (u, v) longs. Self-links, repeated links and either direction are
    allowed; nodes without a link to another do not appear.
    """
    checkpoint_dir(links.sparkSession)
    now = (links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
           .distinct().checkpoint())
    seen = None
    while True:
        now = _small_star(_large_star(now)).where("u <> v").distinct().checkpoint()
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select("v", "v").distinct())
