"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnwork.llm.common import materialize

c = F.col


def components(links: DataFrame) -> DataFrame:
    """(id, component = least id reachable) for every id in ``links`` (a, b: long).

    Alternating large star and small star.  Per-node minima are written before
    they are joined, so both sides of each join are plain shuffles and the
    links of a hub can be split over tasks.  No neighbour list is built.
    """
    links = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    while not _stars(links):
        both = links.union(links.select(c("v").alias("u"), c("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), c("u")).alias("m")), "least")
        large = materialize(
            both.join(least, "u").where("v > u").select(c("v").alias("u"), c("m").alias("v")).where("u <> v").distinct(), "large-star"
        )
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = large.join(lowest, "u").select(c("v").alias("u"), c("m").alias("v")).union(lowest.select("u", c("m").alias("v")))
        links = materialize(small.where("u <> v").distinct(), "small-star")
    roots = links.select(c("v").alias("id"), c("v").alias("component")).distinct()
    return links.select(c("u").alias("id"), c("v").alias("component")).union(roots)


def _stars(links: DataFrame) -> bool:
    """Every u has one link and none is the root of another."""
    seen = links.groupBy("u").agg(F.count("*").alias("n"), F.lit(0).alias("r")).select("u", "n")
    roots = links.select(c("v").alias("u")).distinct().withColumn("n", F.lit(1))
    return seen.union(roots).groupBy("u").agg(F.sum("n").alias("n")).where("n > 1").isEmpty()
