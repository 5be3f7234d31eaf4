"""Connected components by alternating large and small stars, entirely in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) of longs -> node, comp: every node of an edge and the least node it can reach.

    A round sends every neighbour to the least one; rounds grow with the logarithm of the longest path.  Hubs are
    aggregated with map-side combining and joined back, so no task gathers a hub's neighbours.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        done = stored(small.distinct(), "small-star")
        discard(now, large)
        now = done
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
