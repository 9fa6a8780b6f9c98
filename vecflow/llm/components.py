"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecflow.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of the (a, b) links; the component is its smallest id.

    Each round hangs every neighbour on the smallest one in reach, so the rounds grow with the logarithm of a
    component's size. Links are written to the shared folder after each round, and only whether they are settled reaches the driver.
    """
    stars = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "links")
    while not settled(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        large = large.repartition("u")  # sent once, for the least neighbour and for the rest
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialize(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "links")
    ids = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(stars.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def settled(stars: DataFrame) -> bool:
    """Whether every id hangs on one other at most, and on none that hangs itself."""
    hanging = stars.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    held = stars.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    roles = hanging.unionByName(held).groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.where("up + down > 1 AND up > 0").isEmpty()
