"""Table maintenance without UPDATE/MERGE: K-07 .. K-20, S-07, W-03.

Each "update" returns the new version of a table (read -> transform ->
write to a new path); nothing overwrites the data it is reading.

Randomness in the source scripts (``random()``, ``ORDER BY random() LIMIT
1``) is replaced by deterministic bucketing of a key: by default
``xxhash64(key)``, or any bucket expression the caller passes, so reruns and
task retries give the same answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airdata.functions.scalar import with_scalar
from airdata.operators.keys import first_per_key, next_key_after_max
from airdata.operators.scan import numbered, value_at

ROUTE_KEYS = ["airline_id", "origin_airport_id", "destination_airport_id"]

# The seed fleet (manufacturer, model, seat capacity, tail number).
SEED_FLEET = (
    ("Airbus", "A320", 150, None),
    ("Boeing", "737-800", 165, None),
    ("Airbus", "A321", 185, None),
    ("Boeing", "787-8", 242, None),
    ("Airbus", "A350-900", 300, None),
)

def hash_bucket(col, n) -> Column:
    """Deterministic bucket in [0, n) of a key (default randomness stand-in)."""
    c = F.col(col) if isinstance(col, str) else col
    n = F.lit(n) if isinstance(n, int) else n
    return F.pmod(F.xxhash64(c), n)


# ------------------------------------------------------------------ sources
def inline_values(spark: SparkSession, rows, schema: str) -> DataFrame:
    """S-07: a ``VALUES`` relation."""
    return spark.createDataFrame(list(rows), schema)


def seed_if_empty(target: DataFrame, seed: DataFrame) -> DataFrame:
    """W-03: ``INSERT ... SELECT ... WHERE NOT EXISTS (SELECT 1 FROM target)``:
    the seed rows when the target is empty, else nothing. The emptiness test
    is a one-row aggregate joined in, not a driver round trip."""
    n = target.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    return with_scalar(seed, n).filter(F.col("_n") == 0).drop("_n")


def seed_fleet(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The aircraft table after seeding the fixed fleet into an empty table;
    ids follow the VALUES order after the current maximum."""
    schema = "manufacturer string, model string, seat_capacity int, tail_number string"
    values = inline_values(spark, [(m, mo, s, t, i) for i, (m, mo, s, t) in enumerate(SEED_FLEET)],
                           schema + ", _ord int")
    if existing is None:
        existing = spark.createDataFrame([], "aircraft_id bigint, " + schema)
    new = seed_if_empty(existing, values)
    keyed = next_key_after_max(new, existing, "aircraft_id", ["_ord"], num_partitions=1)
    return existing.unionByName(keyed.drop("_ord").select(*existing.columns))


# ------------------------------------------------------------------- routes
def derive_routes_from_flights(flights: DataFrame, routes: DataFrame) -> DataFrame:
    """K-07: distinct (airline, origin, destination) of flights with all keys
    present and no route yet; new ids continue after ``max(route_id)`` in
    key order, distance unknown."""
    cand = flights.select(*ROUTE_KEYS).dropna().distinct()
    new = cand.join(routes.select(*ROUTE_KEYS), ROUTE_KEYS, "left_anti")
    keyed = next_key_after_max(new, routes, "route_id", ROUTE_KEYS)
    return keyed.withColumn("distance_nm", F.lit(None).cast("int")).select(
        "route_id", *ROUTE_KEYS, "distance_nm")


def backfill_route_ids(flights: DataFrame, routes: DataFrame) -> DataFrame:
    """K-08: set ``flights.route_id`` from routes (3-key join) where null.
    The route side is unique on the keys, so the left join never fans out."""
    r = routes.select(*ROUTE_KEYS, F.col("route_id").alias("_rid"))
    j = flights.join(r, ROUTE_KEYS, "left")
    return j.withColumn("route_id", F.coalesce(F.col("route_id"), F.col("_rid"))) \
            .drop("_rid").select(*flights.columns)


def _endpoint_coords(routes: DataFrame, airports: DataFrame) -> DataFrame:
    ao = airports.select(F.col("airport_id").alias("origin_airport_id"),
                         F.col("latitude").cast("double").alias("_lat1"),
                         F.col("longitude").cast("double").alias("_lon1"))
    ad = airports.select(F.col("airport_id").alias("destination_airport_id"),
                         F.col("latitude").cast("double").alias("_lat2"),
                         F.col("longitude").cast("double").alias("_lon2"))
    return routes.join(ao, "origin_airport_id", "left").join(ad, "destination_airport_id", "left")


_COORDS = ["_lat1", "_lon1", "_lat2", "_lon2"]


def haversine_nm(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in nautical miles (R = 6371 km, 1 nm = 1.852 km).
    The asin argument is clamped to 1 so rounding never yields NaN."""
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    return 2 * 6371 * F.asin(F.least(F.lit(1.0), F.sqrt(a))) / 1.852


def update_distance_haversine(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """K-09: fill null ``distance_nm`` with the great-circle distance (rounded
    half to even, as a double -> integer cast) where both ends have
    coordinates."""
    j = _endpoint_coords(routes, airports)
    known = F.col("_lat1").isNotNull() & F.col("_lon1").isNotNull() \
        & F.col("_lat2").isNotNull() & F.col("_lon2").isNotNull()
    d = F.rint(haversine_nm(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))).cast("int")
    return (j.withColumn("distance_nm", F.when(F.col("distance_nm").isNull() & known, d)
                         .otherwise(F.col("distance_nm")))
             .drop(*_COORDS).select(*routes.columns))


def planar_nm(lat1, lon1, lat2, lon2) -> Column:
    return F.sqrt(F.pow(lat2 - lat1, 2) + F.pow(lon2 - lon1, 2)) * 60


def update_distance_planar(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """K-10: overwrite every distance with sqrt(dlat^2 + dlon^2) * 60 where
    both ends have coordinates (numeric -> integer: half away from zero);
    ``_updated`` marks the rows the UPDATE touched."""
    if "distance_nm" not in routes.columns:
        routes = routes.withColumn("distance_nm", F.lit(None).cast("int"))
    j = _endpoint_coords(routes, airports)
    known = F.col("_lat1").isNotNull() & F.col("_lon1").isNotNull() \
        & F.col("_lat2").isNotNull() & F.col("_lon2").isNotNull()
    d = F.round(planar_nm(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))).cast("int")
    return (j.withColumn("_updated", known)
             .withColumn("distance_nm", F.when(known, d).otherwise(F.col("distance_nm")))
             .drop(*_COORDS).select(*routes.columns, "_updated"))


# ----------------------------------------------------------------- aircraft
#: Places of a pool member on the ring, and arcs of it.
POINTS, ARCS = 64, 4096


def ring_place(text: Column) -> Column:
    """A place on a ring of 2^60, by hash."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def assign_from_pool(flights: DataFrame, pool: DataFrame, id_col: str = "aircraft_id",
                     key: str = "flight_id", points: int = POINTS) -> DataFrame:
    """K-11: give every flight without an aircraft a member of the pool.

    Members stand on a hash ring at ``points`` places each, a flight at one, and
    it takes the next member on. So the members are neither counted nor numbered,
    the pool may be of any size, and a member that comes or goes moves only the
    flights beside it. The ring is cut into ARCS arcs; each holds its places and
    the first one behind it, and flights join arcs by number. A flight without a
    key, and any flight where the pool is empty, stays without.
    """
    has = id_col in flights.columns
    cols = flights.columns if has else [*flights.columns, id_col]
    kind = flights.schema[id_col].dataType if has else pool.schema[id_col].dataType
    arc = F.floor(F.col("at") / (2 ** 60 // ARCS))
    stands = pool.filter(F.col(id_col).isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("v"), F.col(id_col).cast(kind).alias("member"))
    place = ring_place(F.concat(F.lit("m"), F.col("member").cast("string"), F.lit("-"), F.col("v").cast("string")))
    # a member that comes twice stands there once
    held = stands.select(place.alias("at"), "member").groupBy(arc.alias("_arc")).agg(F.sort_array(F.collect_set(F.struct("at", "member"))).alias("_in"))
    behind = Window.orderBy("_arc").rowsBetween(1, Window.unboundedFollowing)   # ARCS rows
    whole = Window.orderBy("_arc").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.get("_in", F.lit(0))
    arcs = pool.sparkSession.range(0, ARCS, 1, 1).withColumnRenamed("id", "_arc").join(held, "_arc", "left").select(
        "_arc", "_in", F.coalesce(F.min(first).over(behind), F.min(first).over(whole)).alias("_next"))
    at = ring_place(F.concat(F.lit("r"), F.col(key).cast("string")))
    met = flights.withColumn("_spot", at).withColumn("_arc", F.floor(F.col("_spot") / (2 ** 60 // ARCS))).join(arcs, "_arc", "left")
    ahead = F.get(F.filter("_in", lambda x: x["at"] >= F.col("_spot")), F.lit(0))
    given = F.when(F.col(key).isNotNull(), F.coalesce(ahead["member"], F.col("_next.member")))
    given = F.coalesce(F.col(id_col), given) if has else given
    return met.select(*[given.alias(c) if c == id_col else F.col(c) for c in cols])


def sample_fraction(df: DataFrame, fraction: float, bucket: Column | None = None,
                    key: str = "flight_id", resolution: int = 10_000) -> DataFrame:
    """K-13: repeatable Bernoulli sample: keep rows whose bucket in
    ``[0, resolution)`` is below ``fraction * resolution``."""
    b = bucket if bucket is not None else F.pmod(F.xxhash64(key), F.lit(resolution))
    return df.filter(b < F.lit(int(round(fraction * resolution))))


def apply_change_log(flights: DataFrame, log: DataFrame) -> DataFrame:
    """K-15: set each flight's aircraft to the newest logged value (latest
    ``changed_at``, then highest ``change_id``, then highest aircraft). The log
    is cut to one row per flight before the shuffle and the join."""
    newest = first_per_key(log.filter(F.col("flight_id").isNotNull()), ["flight_id"],
                           [F.col(c).desc() for c in ("changed_at", "change_id", "new_aircraft_id")])
    latest = newest.select("flight_id", F.col("new_aircraft_id").alias("_new"))
    j = flights.join(latest, "flight_id", "left")
    return j.withColumn("aircraft_id", F.coalesce(F.col("_new"), F.col("aircraft_id"))) \
            .drop("_new").select(*flights.columns)


def select_fraction_of_parents(parents: DataFrame, key: str, ratio: float,
                               order: Column | None = None) -> DataFrame:
    """K-18: the first ``floor(n * ratio)`` distinct parents in hash order
    (default ``xxhash64(key)``, ties by key). The order value of the last one is
    an exact order statistic; only the keys up to it are numbered."""
    o = order if order is not None else F.xxhash64(key)
    keys = parents.select(key).distinct().withColumn("_o", o).checkpoint()   # a key and its place a row
    k = F.floor(F.col("_n") * F.lit(ratio))
    last = value_at(keys, "_o", lambda n: F.floor(n * F.lit(ratio)) - 1).scalar()
    kept = numbered(keys.filter(F.col("_o") <= last), ["_o", key], "_at")
    return with_scalar(kept, keys.agg(F.count("_o").alias("_n"))).filter(F.col("_at") <= k).select(key)


# ------------------------------------------------------------ key lookups
def resolve_dimension_keys(rows: DataFrame, airlines: DataFrame, airports: DataFrame,
                           routes: DataFrame | None = None):
    """K-19: natural keys (carrier, origin, destination codes) -> surrogate
    ids by joins on trimmed codes; optional route by a 3-key left join.

    Returns ``(resolved, quarantine)``: rows whose codes do not all resolve go
    to the quarantine frame with the first missing key named, instead of
    vanishing as in an inner join."""
    al = airlines.select(F.btrim("iata_code").alias("_al_code"), F.col("airline_id").alias("_al_id"))
    ao = airports.select(F.btrim("iata_code").alias("_o_code"), F.col("airport_id").alias("_o_id"))
    ad = airports.select(F.btrim("iata_code").alias("_d_code"), F.col("airport_id").alias("_d_id"))
    j = (rows.withColumn("_al_code", F.btrim("airline_code"))
             .withColumn("_o_code", F.btrim("origin_iata"))
             .withColumn("_d_code", F.btrim("dest_iata"))
             .join(al, "_al_code", "left").join(ao, "_o_code", "left").join(ad, "_d_code", "left"))
    reason = (F.when(F.col("_al_id").isNull(), "unknown airline")
               .when(F.col("_o_id").isNull(), "unknown origin airport")
               .when(F.col("_d_id").isNull(), "unknown destination airport"))
    j = j.withColumn("_reason", reason)
    ok = (j.filter(F.col("_reason").isNull())
           .withColumn("airline_id", F.col("_al_id"))
           .withColumn("origin_airport_id", F.col("_o_id"))
           .withColumn("destination_airport_id", F.col("_d_id")))
    if routes is not None:
        ok = ok.join(routes.select(*ROUTE_KEYS, "route_id"), ROUTE_KEYS, "left")
    drop = ["_al_code", "_o_code", "_d_code", "_al_id", "_o_id", "_d_id", "_reason"]
    quarantine = j.filter(F.col("_reason").isNotNull()).withColumn("reason", F.col("_reason")).drop(*drop)
    return ok.drop(*drop), quarantine


def filter_known_dimension(rows: DataFrame, dim: DataFrame, row_key: str, dim_key: str):
    """K-20: keep rows whose key exists in the dimension (left semi); the
    rest go to quarantine (left anti) instead of being dropped silently."""
    d = dim.select(F.col(dim_key).alias(row_key))
    return rows.join(d, row_key, "left_semi"), rows.join(d, row_key, "left_anti")
