"""Catalogue entries for keys and table maintenance (K-01 .. K-20).

Where the source used ``random()``, the queries pass integer bucket
expressions (``pmod(id * a + b, n)``) so DuckDB can repeat them exactly; the
library default is ``xxhash64``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airdata.functions import clean as C
from airdata.operators import keys as K
from airdata.operators import maintain as M
from airdata.operators.metrics import route_distance_summary
from airdata.plans.registry import query
from airdata.plans.views_sql import with_views as W


@query("assign_surrogate_key", "K-01", W("""
SELECT route_id, airline_id, origin_airport_id, destination_airport_id FROM routes""", "routes"))
def _assign_surrogate_key(fx):
    return fx.routes


_DIRTY_CODES_SQL = """
c AS (SELECT airport_id,
             nullif(nullif(regexp_replace(iata_code, '^\\s+|\\s+$', '', 'g'), ''), '\\N') AS iata_code
      FROM airports_dirty)"""


def _dirty_codes(fx):
    return fx.airports_dirty.select("airport_id", C.clean_str("iata_code").alias("iata_code"))


@query("insert_ignore_single_key", "K-02", W(f"""
WITH {_DIRTY_CODES_SQL.strip()},
t AS (SELECT * FROM c WHERE airport_id % 5 = 0),
firsts AS (
  SELECT airport_id, iata_code FROM (
    SELECT *, row_number() OVER (PARTITION BY iata_code ORDER BY airport_id) AS rn
    FROM c WHERE iata_code IS NOT NULL) s WHERE rn = 1
  UNION ALL SELECT airport_id, iata_code FROM c WHERE iata_code IS NULL)
SELECT airport_id, iata_code FROM firsts
WHERE iata_code IS NULL OR iata_code NOT IN (SELECT iata_code FROM t WHERE iata_code IS NOT NULL)""",
    "airports_dirty"))
def _insert_ignore_single_key(fx):
    c = _dirty_codes(fx)
    t = c.filter(F.col("airport_id") % 5 == 0)
    return K.insert_ignore(t, c, ["iata_code"], ["airport_id"])


_LINE_PAIRS_SQL = """
lines AS (
  SELECT l_partkey AS passenger_id, l_orderkey AS flight_id, l_linenumber, l_suppkey
  FROM lineitem WHERE l_partkey IN (SELECT c_custkey FROM customer))"""


def _line_pairs(fx):
    li = fx.table("lineitem", ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey"])
    cust = fx.table("customer", ["c_custkey"])
    return (li.join(cust, li.l_partkey == cust.c_custkey, "left_semi")
              .select(F.col("l_partkey").alias("passenger_id"), F.col("l_orderkey").alias("flight_id"),
                      "l_linenumber", "l_suppkey"))


@query("insert_ignore_pk", "K-03", W(f"""
WITH {_LINE_PAIRS_SQL.strip()},
t AS (SELECT passenger_id, flight_id FROM bookings WHERE booking_id % 4 = 0),
firsts AS (SELECT passenger_id, flight_id, l_linenumber, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY passenger_id, flight_id ORDER BY l_linenumber, l_suppkey) AS rn
  FROM lines) s WHERE rn = 1)
SELECT f.* FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.passenger_id = f.passenger_id AND t.flight_id = f.flight_id)""",
    "bookings"))
def _insert_ignore_pk(fx):
    t = fx.bookings.filter(F.col("booking_id") % 4 == 0).select("passenger_id", "flight_id")
    return K.insert_ignore(t, _line_pairs(fx), ["passenger_id", "flight_id"],
                           ["l_linenumber", "l_suppkey"])


# Row-by-row fold in a recursive CTE: the reference semantics of
# INSERT ... ON CONFLICT DO NOTHING over two unique keys, one row at a time.
_K04_SQL = """
WITH RECURSIVE c AS (
  SELECT row_number() OVER (ORDER BY ord) AS rn, ord, iata_code, icao_code FROM multikey_candidates WHERE ord % 7 <> 3),
fold(rn, ui, uc, kept) AS (
  SELECT 0, coalesce(list(iata_code) FILTER (iata_code IS NOT NULL), CAST([] AS VARCHAR[])),
         coalesce(list(icao_code) FILTER (icao_code IS NOT NULL), CAST([] AS VARCHAR[])), CAST([] AS BIGINT[])
  FROM multikey_candidates WHERE ord % 7 = 3
  UNION ALL
  SELECT c.rn,
         CASE WHEN ok AND c.iata_code IS NOT NULL THEN list_append(f.ui, c.iata_code) ELSE f.ui END,
         CASE WHEN ok AND c.icao_code IS NOT NULL THEN list_append(f.uc, c.icao_code) ELSE f.uc END,
         CASE WHEN ok THEN list_append(f.kept, c.ord) ELSE f.kept END
  FROM fold f JOIN (
    SELECT c1.*, f1.rn AS prev FROM c c1 JOIN fold f1 ON c1.rn = f1.rn + 1) c ON c.prev = f.rn,
  LATERAL (SELECT (c.iata_code IS NULL OR NOT list_contains(f.ui, c.iata_code))
                  AND (c.icao_code IS NULL OR NOT list_contains(f.uc, c.icao_code)) AS ok) x)
SELECT m.ord, m.iata_code, m.icao_code FROM multikey_candidates m
WHERE m.ord IN (SELECT unnest(kept) FROM fold WHERE rn = (SELECT max(rn) FROM c))"""


@query("insert_ignore_any_unique", "K-04", W(_K04_SQL, "multikey_candidates"))
def _insert_ignore_any_unique(fx):
    cand = fx.multikey_candidates
    taken = cand.filter(F.col("ord") % 7 == 3)   # rows of an earlier load
    return K.insert_ignore_any_unique(taken, cand.filter(F.col("ord") % 7 != 3), ["iata_code", "icao_code"], "ord")


@query("dedup_pairs_against_existing", "K-05", W(f"""
WITH {_LINE_PAIRS_SQL.strip()}
SELECT DISTINCT passenger_id, flight_id FROM lines l
WHERE NOT EXISTS (SELECT 1 FROM bookings b WHERE b.booking_id % 3 = 0
                  AND b.passenger_id = l.passenger_id AND b.flight_id = l.flight_id)""", "bookings"))
def _dedup_pairs_against_existing(fx):
    existing = fx.bookings.filter(F.col("booking_id") % 3 == 0)
    return K.dedup_pairs_against_existing(existing, _line_pairs(fx), ["passenger_id", "flight_id"])


@query("new_rows_since", "K-06", W("""
WITH log AS (SELECT row_number() OVER (ORDER BY paid_at, payment_id) AS event_id, payment_id, paid_at,
                    amount_usd FROM payments)
SELECT event_id, payment_id, cast(amount_usd AS double) AS amount_usd FROM log
WHERE event_id > (SELECT coalesce(max(event_id), -4611686018427387904) FROM log
                  WHERE paid_at < TIMESTAMP '1998-01-01')""", "payments"))
def _new_rows_since(fx):
    # An append-only payment log whose ids follow time (K-01 over paid_at);
    # the previous load ended with the last 1997 payment.
    log = K.assign_surrogate_key(fx.payments.select("payment_id", "paid_at", "amount_usd"),
                                 ["paid_at", "payment_id"], "event_id")
    prev = log.filter(F.col("paid_at") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return K.new_rows_since(log, prev, "event_id").select(
        "event_id", "payment_id", F.col("amount_usd").cast("double").alias("amount_usd"))


@query("derive_routes_from_flights", "K-07", W("""
WITH existing AS (SELECT * FROM routes WHERE route_id % 3 <> 0),
new AS (
  SELECT DISTINCT f.airline_id, f.origin_airport_id, f.destination_airport_id FROM flights_base f
  LEFT JOIN existing r ON r.airline_id = f.airline_id AND r.origin_airport_id = f.origin_airport_id
   AND r.destination_airport_id = f.destination_airport_id
  WHERE r.route_id IS NULL AND f.airline_id IS NOT NULL AND f.origin_airport_id IS NOT NULL
    AND f.destination_airport_id IS NOT NULL)
SELECT (SELECT coalesce(max(route_id), 0) FROM existing)
         + row_number() OVER (ORDER BY airline_id, origin_airport_id, destination_airport_id) AS route_id,
       airline_id, origin_airport_id, destination_airport_id, CAST(NULL AS INTEGER) AS distance_nm
FROM new""", "routes", "flights_base"))
def _derive_routes_from_flights(fx):
    existing = fx.routes.filter(F.col("route_id") % 3 != 0)
    return M.derive_routes_from_flights(fx.flights_base, existing)


@query("backfill_route_ids", "K-08", W("""
SELECT f.flight_id, coalesce(f.route_id, r.route_id) AS route_id
FROM flights f LEFT JOIN routes r ON r.airline_id = f.airline_id
 AND r.origin_airport_id = f.origin_airport_id AND r.destination_airport_id = f.destination_airport_id""",
    "flights", "routes"))
def _backfill_route_ids(fx):
    return M.backfill_route_ids(fx.flights, fx.routes).select("flight_id", "route_id")


_HAV = """2 * 6371 * asin(least(1.0, sqrt(
  pow(sin(radians(cast(ad.latitude AS double) - cast(ao.latitude AS double)) / 2), 2)
  + cos(radians(cast(ao.latitude AS double))) * cos(radians(cast(ad.latitude AS double)))
  * pow(sin(radians(cast(ad.longitude AS double) - cast(ao.longitude AS double)) / 2), 2)))) / 1.852"""


@query("update_distance_haversine", "K-09", W(f"""
SELECT r.route_id,
       CASE WHEN ao.latitude IS NOT NULL AND ao.longitude IS NOT NULL AND ad.latitude IS NOT NULL
                 AND ad.longitude IS NOT NULL
            THEN cast(round_even({_HAV}, 0) AS integer) END AS distance_nm
FROM routes r LEFT JOIN airports ao ON ao.airport_id = r.origin_airport_id
LEFT JOIN airports ad ON ad.airport_id = r.destination_airport_id""", "routes", "airports"))
def _update_distance_haversine(fx):
    r = fx.routes.withColumn("distance_nm", F.lit(None).cast("int"))
    return M.update_distance_haversine(r, fx.airports).select("route_id", "distance_nm")


_PLANAR_UPDATED_SQL = """
planar AS (
  SELECT r.route_id,
         CASE WHEN ao.latitude IS NOT NULL AND ao.longitude IS NOT NULL AND ad.latitude IS NOT NULL
                   AND ad.longitude IS NOT NULL
              THEN cast(round(sqrt(pow(cast(ad.latitude - ao.latitude AS double), 2)
                                   + pow(cast(ad.longitude - ao.longitude AS double), 2)) * 60) AS integer)
         END AS distance_nm,
         ao.latitude IS NOT NULL AND ao.longitude IS NOT NULL AND ad.latitude IS NOT NULL
           AND ad.longitude IS NOT NULL AS updated
  FROM routes r LEFT JOIN airports ao ON ao.airport_id = r.origin_airport_id
  LEFT JOIN airports ad ON ad.airport_id = r.destination_airport_id)"""


def _planar(fx):
    return M.update_distance_planar(fx.routes, fx.airports)


@query("update_distance_planar", "K-10", W(f"""
WITH {_PLANAR_UPDATED_SQL.strip()}
SELECT count(*) FILTER (WHERE updated) AS updated_routes FROM planar""", "routes", "airports"))
def _update_distance_planar(fx):
    return _planar(fx).agg(F.count(F.when(F.col("_updated"), 1)).alias("updated_routes"))


@query("route_distance_summary", "A-08", W(f"""
WITH {_PLANAR_UPDATED_SQL.strip()}
SELECT count(*) AS total_routes, count(distance_nm) AS routes_with_distance,
       min(distance_nm) AS min_distance, max(distance_nm) AS max_distance FROM planar""",
    "routes", "airports"))
def _route_distance_summary(fx):
    return route_distance_summary(_planar(fx))


# ---------------------------------------------------------------- aircraft
# The seed fleet.
_FLEET_SQL = """
fleet AS (SELECT row_number() OVER () AS aircraft_id, * FROM (VALUES
  ('Airbus', 'A320', 150), ('Boeing', '737-800', 165), ('Airbus', 'A321', 185),
  ('Boeing', '787-8', 242), ('Airbus', 'A350-900', 300)) v(manufacturer, model, seat_capacity))"""

# the next member on a hash ring, 64 places a member; behind the last place comes the first
_ASSIGNED_SQL = """
stand AS (SELECT m AS aircraft_id, CAST('0x' || substr(md5('m' || m || '-' || v), 1, 15) AS BIGINT) AS spot FROM range(1, 6) p(m), range(64) t(v)),
asked AS (SELECT flight_id, flight_date, CAST('0x' || substr(md5('r' || flight_id), 1, 15) AS BIGINT) AS place FROM flights),
assigned AS (
  SELECT flight_id, flight_date, coalesce(stand.aircraft_id, (SELECT arg_min(aircraft_id, spot) FROM stand)) AS aircraft_id
  FROM asked ASOF LEFT JOIN stand ON asked.place <= stand.spot)"""


def _assigned(fx):
    fleet = M.seed_fleet(fx.spark)
    f = fx.flights_base.select("flight_id", "flight_date")
    return M.assign_from_pool(f, fleet.select("aircraft_id")), fleet


@query("assign_from_pool", "K-11", W(f"""
WITH {_FLEET_SQL.strip()}, {_ASSIGNED_SQL.strip()}
SELECT a.flight_id, a.aircraft_id, fl.model FROM assigned a JOIN fleet fl ON fl.aircraft_id = a.aircraft_id""",
    "flights"))
def _assign_from_pool(fx):
    a, fleet = _assigned(fx)
    return a.join(fleet.select("aircraft_id", "model"), "aircraft_id").select(
        "flight_id", "aircraft_id", "model")


@query("sample_fraction", "K-13", W("""
SELECT flight_id, flight_date FROM flights_base WHERE (flight_id * 7919) % 10000 < 500""", "flights_base"))
def _sample_fraction(fx):
    f = fx.flights_base.select("flight_id", "flight_date")
    return M.sample_fraction(f, 0.05, bucket=F.pmod(F.col("flight_id") * 7919, F.lit(10000)))


# The lines of an order are the log of its flight: a returned line puts the
# flight on another unit when it ships.
@query("apply_change_log", "K-15", W(f"""
WITH {_ASSIGNED_SQL.strip()},
ranked AS (
  SELECT l_orderkey AS flight_id, l_suppkey AS unit,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC) AS place
  FROM lineitem WHERE l_returnflag = 'R')
SELECT flight_id, coalesce(unit, aircraft_id) AS aircraft_id
FROM assigned LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (flight_id)""", "flights"))
def _apply_change_log(fx):
    a, _ = _assigned(fx)
    li = fx.table("lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag"])
    log = li.filter(F.col("l_returnflag") == "R").select(
        F.col("l_linenumber").alias("change_id"), F.col("l_orderkey").alias("flight_id"),
        F.col("l_suppkey").alias("new_aircraft_id"), F.col("l_shipdate").alias("changed_at"))
    return M.apply_change_log(a.select("flight_id", "aircraft_id"), log)


@query("select_fraction_of_parents", "K-18", W("""
WITH p AS (SELECT DISTINCT passenger_id FROM bookings),
r AS (SELECT passenger_id, row_number() OVER (ORDER BY (passenger_id * 7919) % 1000003, passenger_id) AS rk
      FROM p)
SELECT passenger_id FROM r WHERE rk <= (SELECT floor(count(*) * 0.6) FROM p)""", "bookings"))
def _select_fraction_of_parents(fx):
    return M.select_fraction_of_parents(fx.bookings.select("passenger_id"), "passenger_id", 0.6,
                                        order=F.pmod(F.col("passenger_id") * 7919, F.lit(1000003)))


_RAW_CODES_SQL = """
raw AS (
  SELECT f.flight_id, al.iata_code AS airline_code, concat(' ', ao.iata_code) AS origin_iata,
         ad.iata_code AS dest_iata
  FROM flights_orphan f LEFT JOIN airlines al ON al.airline_id = f.airline_id
  LEFT JOIN airports ao ON ao.airport_id = f.origin_airport_id
  LEFT JOIN airports ad ON ad.airport_id = f.destination_airport_id)"""


def _raw_codes(fx):
    f = fx.flights_orphan
    al = fx.airlines.select("airline_id", F.col("iata_code").alias("airline_code"))
    ao = fx.airports.select(F.col("airport_id").alias("origin_airport_id"),
                            F.concat(F.lit(" "), F.col("iata_code")).alias("origin_iata"))
    ad = fx.airports.select(F.col("airport_id").alias("destination_airport_id"),
                            F.col("iata_code").alias("dest_iata"))
    return (f.join(al, "airline_id", "left").join(ao, "origin_airport_id", "left")
             .join(ad, "destination_airport_id", "left")
             .select("flight_id", "airline_code", "origin_iata", "dest_iata"))


@query("resolve_dimension_keys", "K-19", W(f"""
WITH {_RAW_CODES_SQL.strip()}
SELECT r.flight_id, al.airline_id, ao.airport_id AS origin_airport_id,
       ad.airport_id AS destination_airport_id, rt.route_id
FROM raw r JOIN airlines al ON trim(al.iata_code) = trim(r.airline_code)
JOIN airports ao ON trim(ao.iata_code) = trim(r.origin_iata)
JOIN airports ad ON trim(ad.iata_code) = trim(r.dest_iata)
LEFT JOIN routes rt ON rt.airline_id = al.airline_id AND rt.origin_airport_id = ao.airport_id
 AND rt.destination_airport_id = ad.airport_id""", "flights_orphan", "airlines", "airports", "routes"))
def _resolve_dimension_keys(fx):
    ok, _ = M.resolve_dimension_keys(_raw_codes(fx), fx.airlines, fx.airports, fx.routes)
    return ok.select("flight_id", "airline_id", "origin_airport_id", "destination_airport_id", "route_id")


@query("resolve_dimension_quarantine", "K-19", W(f"""
WITH {_RAW_CODES_SQL.strip()},
q AS (SELECT CASE WHEN al.airline_id IS NULL THEN 'unknown airline'
                  WHEN ao.airport_id IS NULL THEN 'unknown origin airport'
                  WHEN ad.airport_id IS NULL THEN 'unknown destination airport' END AS reason
      FROM raw r LEFT JOIN airlines al ON trim(al.iata_code) = trim(r.airline_code)
      LEFT JOIN airports ao ON trim(ao.iata_code) = trim(r.origin_iata)
      LEFT JOIN airports ad ON trim(ad.iata_code) = trim(r.dest_iata))
SELECT reason, count(*) AS rows FROM q WHERE reason IS NOT NULL GROUP BY reason""",
    "flights_orphan", "airlines", "airports"))
def _resolve_dimension_quarantine(fx):
    _, bad = M.resolve_dimension_keys(_raw_codes(fx), fx.airlines, fx.airports)
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query("filter_known_dimension", "K-20", W("""
SELECT 'kept' AS outcome, count(*) AS rows, cast(sum(arrivals) AS bigint) AS arrivals FROM flight_performance
WHERE airport_iata IN (SELECT iata_code FROM airports WHERE latitude IS NOT NULL)
UNION ALL
SELECT 'quarantined', count(*), cast(sum(arrivals) AS bigint) FROM flight_performance
WHERE airport_iata NOT IN (SELECT iata_code FROM airports WHERE latitude IS NOT NULL)""",
    "flight_performance", "airports"))
def _filter_known_dimension(fx):
    known = fx.airports.filter(F.col("latitude").isNotNull())
    keep, bad = M.filter_known_dimension(fx.flight_performance, known, "airport_iata", "iata_code")

    def summary(df, label):
        return df.agg(F.lit(label).alias("outcome"), F.count(F.lit(1)).alias("rows"),
                      F.sum("arrivals").cast("bigint").alias("arrivals"))
    return reduce(DataFrame.unionByName, [summary(keep, "kept"), summary(bad, "quarantined")])

