"""Route network queries (A-15 .. A-17): bounded-depth path search.

The source uses ``WITH RECURSIVE`` capped at 3 hops. The depth bound makes
the recursion a fixed plan of joins, so it is unrolled: each hop is an
equi-join of the current frontier with the edge table (Catalyst picks
broadcast or shuffle per hop from measured sizes) plus a cycle filter on the
path array. Reports show the first few hundred of millions of paths: paths are
counted by destination first, from leg to leg, and only those that can be shown
are put together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def route_counts_by_origin(routes: DataFrame) -> DataFrame:
    return routes.groupBy("origin_airport_id").agg(F.count(F.lit(1)).alias("route_count"))


def busiest_origin(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """A-15: the origin with most outgoing routes (airline multiplicity
    counted; ties by the lower airport id), with its IATA code."""
    top = (route_counts_by_origin(routes)
           .orderBy(F.col("route_count").desc(), "origin_airport_id").limit(1))
    ap = airports.select(F.col("airport_id").alias("origin_airport_id"), "iata_code")
    return top.join(ap, "origin_airport_id").select(
        F.col("origin_airport_id").alias("airport_id"), "iata_code", "route_count")


def legs(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """One row a directed airport pair: _src, _dst, _dst_iata and _n, the number
    of parallel routes (airlines). Parallel routes are counted here, before any
    hop, so the frontier never carries copies of a path."""
    pairs = (routes.groupBy(F.col("origin_airport_id").alias("_src"),
                            F.col("destination_airport_id").alias("_dst"))
                   .agg(F.count(F.lit(1)).alias("_n")))
    ap = airports.select(F.col("airport_id").alias("_dst"), F.col("iata_code").alias("_dst_iata"))
    return pairs.join(ap, "_dst")


def _extend(level: DataFrame, edges: DataFrame, hops: int) -> DataFrame:
    """The simple paths one leg longer. The cycle test is on IATA text with SQL
    ``= ANY`` semantics: a null code (in the path or the candidate) stops
    extension. The first hop has no test: a route is never a loop."""
    nxt = level.withColumnRenamed("dest_airport_id", "_src").join(edges, "_src")
    if hops > 1:
        nxt = nxt.filter(F.coalesce(~F.array_contains(F.col("path"), F.col("_dst_iata")), F.lit(False)))
    return nxt.select("origin_iata", F.col("_dst").alias("dest_airport_id"), F.col("_dst_iata").alias("dest_iata"),
                      F.array_append(F.col("path"), F.col("_dst_iata")).alias("path"),
                      (F.col("copies") * F.col("_n")).alias("copies"), F.lit(hops).alias("hops"))


def _beginning(start: DataFrame) -> DataFrame:
    return start.select(F.col("airport_id").alias("dest_airport_id"), F.col("iata_code").alias("origin_iata"),
                        F.array("iata_code").alias("path"), F.lit(1).cast("bigint").alias("copies"))


def path_levels(start: DataFrame, routes: DataFrame, airports: DataFrame, max_hops: int = 3) -> list[DataFrame]:
    """The simple paths from the start airport(s), one frame a number of hops.

    ``start`` has ``airport_id`` and ``iata_code``. Columns: origin_iata,
    dest_airport_id, dest_iata, path (array of IATA codes), hops and copies,
    the product of the parallel routes along the path.
    """
    edges, level, levels = legs(routes, airports), _beginning(start), []
    for h in range(1, max_hops + 1):
        level = _extend(level, edges, h)
        levels.append(level)
    return levels


def paths_from(start: DataFrame, routes: DataFrame, airports: DataFrame, max_hops: int = 3) -> DataFrame:
    """All simple paths of 1..max_hops legs, each once, with ``copies``."""
    return reduce(DataFrame.unionByName, path_levels(start, routes, airports, max_hops))


def destination_counts(start: DataFrame, edges: DataFrame, airports: DataFrame) -> list[DataFrame]:
    """For 1, 2 and 3 hops: dest_iata and paths, no more than the distinct simple
    paths (as text) that end there.

    Counted from leg to leg, without any path: the walks of two legs by their
    end, then of three; off go the walks that come back to the airport before,
    to the start, or, of three legs, as many as pass the destination's code on
    the way. Where airports share a code, ids are more than texts: with at most
    r airports a code, each of h - 1 stops stands for r ids.
    """
    s = start.select(F.col("airport_id").alias("_src"), F.col("iata_code").alias("_s"))
    shared = F.coalesce(airports.filter("iata_code is not null").groupBy("iata_code").count().agg(F.max("count")).scalar(), F.lit(1))
    one = s.join(edges, "_src").select(F.col("_dst").alias("_a"), F.col("_dst_iata").alias("_ca"), "_s")
    first = one.groupBy(F.col("_ca").alias("dest_iata")).agg(F.lit(1).cast("bigint").alias("paths"))
    step = edges.select(F.col("_src").alias("_a"), F.col("_dst").alias("_b"), F.col("_dst_iata").alias("_cb"))
    two = (one.join(step, "_a").filter((F.col("_cb") != F.col("_ca")) & (F.col("_cb") != F.col("_s")))
              .groupBy("_b", "_cb", "_s", "_ca").agg(F.count(F.lit(1)).alias("_w")))
    ends = two.groupBy("_b", "_cb", "_s").agg(F.sum("_w").alias("_w"))
    second = ends.groupBy(F.col("_cb").alias("dest_iata")).agg(F.floor(F.max("_w") / shared).alias("paths"))
    passing = two.groupBy(F.col("_ca").alias("_cc")).agg(F.sum("_w").alias("_m"))
    last = edges.select(F.col("_src").alias("_b"), F.col("_dst").alias("_c"), F.col("_dst_iata").alias("_cc"))
    three = (ends.join(last, "_b").filter((F.col("_cc") != F.col("_cb")) & (F.col("_cc") != F.col("_s")))
                 .groupBy("_c", "_cc").agg(F.sum("_w").alias("_w")).join(passing, "_cc", "left")
                 .groupBy(F.col("_cc").alias("dest_iata"))
                 .agg(F.floor(F.max(F.col("_w") - F.coalesce("_m", F.lit(0))) / (shared * shared)).alias("paths")))
    return [first, second, three]


def first_destinations(counts: DataFrame, limit: int) -> tuple[int, str | None]:
    """How many paths there are at least, up to ``limit`` and over, and the code
    up to which the destinations hold the first ``limit`` (None: all are needed).
    A destination that has a path holds one at least, so the first ``limit`` of
    them tell; only one row comes back."""
    top = counts.filter("paths > 0 and dest_iata is not null").orderBy("dest_iata").limit(limit)
    upto = Window.orderBy("dest_iata").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # ``limit`` rows
    top = top.withColumn("_to", F.sum("paths").over(upto))
    return tuple(top.agg(F.coalesce(F.max("_to"), F.lit(0)), F.min(F.when(F.col("_to") >= limit, F.col("dest_iata")))).first())


def first_paths(routes: DataFrame, airports: DataFrame, limit: int, deepest_first: bool) -> DataFrame:
    """The paths of up to 3 hops from the busiest origin among which the first
    ``limit`` are, by number of hops, destination and path.

    Numbers of hops that come after the limit is filled are left out, and only
    legs into the destinations that hold the first ``limit`` enter the last hop.
    """
    edges = legs(routes, airports).checkpoint()   # an airport pair a row, read by every hop
    start = busiest_origin(routes, airports).select("airport_id", "iata_code").checkpoint()
    counts, levels, left = destination_counts(start, edges, airports), [_beginning(start)], limit
    for h in range(1, 4):
        levels.append(_extend(levels[-1], edges, h))
    kept = []
    for h in (3, 2, 1) if deepest_first else (1, 2, 3):
        many, cut = first_destinations(counts[h - 1], limit)
        near = F.col("_dst_iata").isNull() | (F.col("_dst_iata") <= F.lit(cut)) if cut is not None else F.lit(True)
        kept.append(_extend(levels[h - 1], edges.filter(near), h))
        left -= many
        if left <= 0:
            break
    return reduce(DataFrame.unionByName, kept).select("origin_iata", "dest_iata", "hops", F.array_join("path", ">").alias("path"), "copies")


def connectivity_3hop(routes: DataFrame, airports: DataFrame, limit: int = 200) -> DataFrame:
    """A-16: distinct (origin, destination, hops, path) reachable from the
    busiest origin within 3 hops; order hops, destination, path."""
    found = first_paths(routes, airports, limit, deepest_first=False)
    return found.select("origin_iata", "dest_iata", "hops", "path").distinct().orderBy("hops", "dest_iata", "path").limit(limit)


def multihop_paths(routes: DataFrame, airports: DataFrame, limit: int = 50) -> DataFrame:
    """A-17: every path (parallel routes repeat it), deepest first.

    A path counts at least once, so the first ``limit`` distinct ones hold the
    first ``limit`` repeated ones; only those are written out."""
    found = first_paths(routes, airports, limit, deepest_first=True)
    top = found.orderBy(F.col("hops").desc(), "dest_iata", "path").limit(limit)
    each = top.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("copies", F.lit(limit).cast("bigint")))))
    return each.select("origin_iata", "dest_iata", "hops", "path").orderBy(F.col("hops").desc(), "dest_iata", "path").limit(limit)
