"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's smallest node.

    Each round joins every edge with the smallest neighbour of an end, a
    hash-aggregated minimum: the many edges of one node never meet in one group.
    Loops, repeated edges and their direction change nothing; edges with a null end are
    left out; no edges give no rows.
    The driver sees a count and a checksum per round.
    """
    star = materialize(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                       .distinct(), "edges")
    before = None
    while True:
        both = star.select(F.col("u").alias("n"), F.col("v").alias("m")).union(star.select("v", "u"))
        low = both.groupBy("n").agg(F.min("m").alias("r")).select("n", F.least("n", "r").alias("r"))
        large = both.join(low, "n").where("m > n").select(F.col("m").alias("u"), F.col("r").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("r"))
        small = (large.join(low, "u").where("v != r").select(F.col("v").alias("u"), F.col("r").alias("v"))
                 .union(low.select("u", "r")).distinct())
        star = materialize(small, "star")
        now = star.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        star.select("v", "v").distinct())
