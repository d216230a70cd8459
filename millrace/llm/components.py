"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, both long): ``root`` is the component's least node.

    Large-star and small-star in turn (Kiveris et al., 2014): each round hangs nodes below the least
    neighbour, which is found by an aggregation and brought back by a join, so no neighbourhood is
    gathered in one place. Rounds grow with the logarithm of the component's size. Every round is written
    to the shared folder.
    """
    stars = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    before = None
    while True:
        mark = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == before:
            break
        before = mark
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
        stars = materialize(small.select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct(), "small-star")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
