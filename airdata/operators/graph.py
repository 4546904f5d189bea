"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def connected_components(links: DataFrame) -> tuple[DataFrame, int]:
    """(node, component: the smallest node it can reach) for every node of the
    links (u, v), and the number of rounds it took.

    In a round every node tells its larger neighbours, then its smaller ones, the
    smallest node it knows of, and keeps one link to that. A path gets shorter by
    half at least, so rounds grow with the logarithm of the longest. Each round
    is written to the checkpoint folder, so a lost executor repeats one at most.
    """
    def pointed(pairs):   # larger end, smaller end
        return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct().checkpoint()

    now, rounds = pointed(links), 0
    while True:
        rounds += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        known = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = pointed(both.join(known, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        mine = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = pointed(mine)
        if small.count() == now.count() and small.exceptAll(now).isEmpty():
            break
        now = small
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), rounds
