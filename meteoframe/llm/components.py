"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, so no neighbour list is ever
gathered; a hub's rows are split by AQE's skew join. Steps repeat until the
table no longer changes, in about log(n) rounds. Rounds are written tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import written


def _pointed(links: DataFrame, keep: Column) -> DataFrame:
    """Each link (u, v) that ``keep`` admits, with v hung on the least of u and u's admitted neighbours."""
    both = links.filter(keep)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_pointed(both, F.lit(True)).filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    hung = _pointed(down, F.lit(True))
    return (hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(hung.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the least node reachable from each node that has a link; nodes without links are left out.

    Null ends and self-links are ignored; repeated links count once; an empty
    table gives an empty result.
    """
    now = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "links")
    mark = lambda d: tuple(d.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    was = mark(now)
    while was[0]:
        now = written(_small_star(_large_star(now)), "star")
        if (is_now := mark(now)) == was:
            break
        was = is_now
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
