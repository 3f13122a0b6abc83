"""Connected components by alternating large-star and small-star rounds on an edge table.

Every round is a few shuffles of edges with map-side combined minima, written to the shared folder so that the lineage
stays short. The driver sees a count and a checksum a round. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, materialise


def components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) -> (node, label): for each node of an edge between different nodes the least node it reaches."""
    e = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    last = None
    while True:
        state = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(state) == last or not state[0]:
            break
        last = tuple(state)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        new = materialise(small, "edges")
        forget(e)
        e = new
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(e.select("v", "v").distinct())
