"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is two aggregations with a map-side minimum and two joins on
the node; neighbour lists are never collected, so a hub costs no more than
its links.  The minima are stored before the join: a join of two stored
tables is one whose partitions Spark splits where a hub holds many links.
Each round's links are written to the shared folder; the
driver reads only their count and checksum.  The number of rounds grows
with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u")).toDF("x", "y")
    least = store(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "cc-least")
    return both.filter("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = store(links.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) links -> (node, root), root the smallest node reachable; nodes without links are not listed."""
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    links = store(links, "cc")
    seen = None
    for _ in range(max_rounds):
        links = store(_small_star(_large_star(links)), "cc")
        mark = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
