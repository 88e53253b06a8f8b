"""Connected components of a table of links, by alternating large and small stars.

Every step hooks neighbours to the least neighbour; the links are staged after each round, so the plan
stays short and nothing is collected. The links of a hot vertex are dealt over many tasks (see
``common.join_unique``); its least neighbour is found by partial sums in every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_unique, stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (join_unique(both, least, ["u"]).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hooked = join_unique(down, least, ["u"]).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return hooked.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` for every vertex of the links ``u, v`` but the least of each component (which is
    ``comp`` itself)."""
    state = F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    before = now.agg(*state).first()
    while before[0]:
        now = stage(_small_star(_large_star(now)), "stars")
        after = now.agg(*state).first()
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
