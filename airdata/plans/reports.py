"""Catalogue entries for the report helpers (P-01 .. P-20)."""

from __future__ import annotations

from airdata.operators import reports as P
from airdata.plans.registry import query
from airdata.plans.views_sql import with_views as W


def R(x, n=2):
    """Oracle-side rounding through decimal, as ``round_half_up``."""
    return f"cast(round(cast(({x}) AS decimal(38,10)), {n}) AS double)"


def PCT(num, den):
    return R(f"cast(100 * ({num}) AS double) / nullif({den}, 0)")


@query("get_revenue_by_fare_class", "P-01", W(f"""
WITH taken AS (SELECT fare_class, amount_usd FROM bookings, payments
               WHERE payments.booking_id = bookings.booking_id AND status = 'Captured')
SELECT fare_class, count(*) AS bookings, sum(amount_usd)::DOUBLE AS revenue_usd,
       {R("sum(amount_usd)::DOUBLE / count(*)")} AS avg_revenue_per_booking
FROM taken GROUP BY ALL""", "bookings", "payments"))
def _p01(fx):
    return P.get_revenue_by_fare_class(fx.bookings, fx.payments)


@query("get_monthly_revenue", "P-02", W("""
SELECT make_date(year(paid_at), month(paid_at), 1) AS month, (sum(amount_usd) FILTER (status = 'Captured'))::DOUBLE AS revenue_usd
FROM payments GROUP BY ALL HAVING count_if(status = 'Captured') > 0""", "payments"))
def _p02(fx):
    return P.get_monthly_revenue(fx.payments)


@query("get_payment_success_by_channel", "P-03", W(f"""
WITH tally AS (
  SELECT booking_channel, status = 'Captured' AS got, count(*) AS n FROM payments JOIN bookings USING (booking_id) GROUP BY ALL)
SELECT booking_channel, sum(n)::BIGINT AS total_payments, coalesce(sum(n) FILTER (got), 0)::BIGINT AS successful_payments,
       {PCT("successful_payments", "total_payments")} AS success_rate_pct
FROM tally GROUP BY ALL""", "bookings", "payments"))
def _p03(fx):
    return P.get_payment_success_by_channel(fx.bookings, fx.payments)


@query("get_busiest_airports", "P-04", W("""
WITH touched AS (SELECT DISTINCT flight_id, unnest([origin_airport_id, destination_airport_id]) AS airport_id FROM flights)
SELECT airport_id, iata_code, name, count(*) AS flight_count
FROM touched JOIN airports USING (airport_id) GROUP BY ALL ORDER BY flight_count DESC, airport_id LIMIT 10""", "flights", "airports"))
def _p04(fx):
    return P.get_busiest_airports(fx.flights_base, fx.airports)


@query("get_airline_punctuality", "P-05", W("""
SELECT airline_iata, sum(arrivals)::BIGINT AS total_arrivals, sum(arrivals_delayed_15min)::BIGINT AS delayed_15min,
       sum(arr_cancelled)::BIGINT AS cancelled, sum(arr_diverted)::BIGINT AS diverted,
       sum(total_arrival_delay_min) AS total_delay_min,
       total_delay_min / nullif(greatest(sum(arrivals), 0), 0) AS avg_delay_min
FROM flight_performance GROUP BY ALL""", "flight_performance"))
def _p05(fx):
    return P.get_airline_punctuality(fx.flight_performance)


_CLV = """
clv AS (SELECT passenger_id, sum(amount_usd) AS clv_usd
        FROM (SELECT booking_id, amount_usd FROM payments WHERE status = 'Captured') JOIN bookings USING (booking_id)
        GROUP BY ALL)"""


def _clv(fx):
    return fx.clv


@query("get_clv", "P-06", W(f"""
WITH {_CLV.strip()} SELECT passenger_id, cast(clv_usd AS double) AS clv_usd FROM clv ORDER BY clv_usd DESC""",
    "bookings", "payments"))
def _p06(fx):
    from pyspark.sql import functions as F
    return _clv(fx).withColumn("clv_usd", F.col("clv_usd").cast("double"))


_TOP = """
ranked AS (SELECT passenger_id, clv_usd,
                  row_number() OVER (ORDER BY clv_usd DESC, passenger_id) AS clv_rank FROM clv),
top AS (SELECT * FROM ranked WHERE clv_rank <= (SELECT greatest(1, floor(count(*) * 0.05)) FROM clv))"""


@query("get_top_customers", "P-07", W(f"""
WITH {_CLV.strip()}, {_TOP.strip()}
SELECT passenger_id, cast(clv_usd AS double) AS clv_usd, clv_rank FROM top""", "bookings", "payments"))
def _p07(fx):
    from pyspark.sql import functions as F
    return P.get_top_customers(_clv(fx)).withColumn("clv_usd", F.col("clv_usd").cast("double"))


@query("get_worst_routes", "P-08", W(f"""
WITH flown AS (
  SELECT route_id, count(*) AS flights, sum(delay_minutes)::DOUBLE AS minutes, count(delay_minutes) AS known,
         count_if(status = 'Cancelled') AS off FROM flights GROUP BY ALL)
SELECT route_id, (SELECT iata_code FROM airports WHERE airport_id = origin_airport_id) AS origin_iata,
       (SELECT iata_code FROM airports WHERE airport_id = destination_airport_id) AS dest_iata, flights,
       {R("minutes / nullif(known, 0)")} AS avg_delay_min, {PCT("off", "flights")} AS cancel_rate_pct
FROM flown JOIN routes USING (route_id) ORDER BY avg_delay_min DESC NULLS LAST, route_id LIMIT 10""", "flights", "routes", "airports"))
def _p08(fx):
    return P.get_worst_routes(fx.flights, fx.routes, fx.airports)


@query("get_delay_by_month", "P-09", W(f"""
WITH late AS (SELECT make_date(year(flight_date), month(flight_date), 1) AS month, (delay_minutes > 15) IS TRUE AS over
              FROM flights WHERE flight_date IS NOT NULL)
SELECT month, {PCT("count_if(over)", "count(*)")} AS pct_delayed FROM late GROUP BY ALL""", "flights"))
def _p09(fx):
    return P.get_delay_by_month(fx.flights_base)


@query("get_airports_for_map", "P-10", W("""
SELECT airport_id, iata_code, name, country, latitude::DOUBLE AS latitude, longitude::DOUBLE AS longitude
FROM airports WHERE latitude + longitude IS NOT NULL
  AND (airport_id IN (SELECT origin_airport_id FROM flights) OR airport_id IN (SELECT destination_airport_id FROM flights))""", "airports", "flights"))
def _p10(fx):
    return P.get_airports_for_map(fx.flights_base, fx.airports)


_OD = """
tally AS (SELECT origin_airport_id AS o, destination_airport_id AS d, count(*) AS n FROM flights GROUP BY ALL),
odp AS (SELECT x.iata_code AS origin_iata, y.iata_code AS dest_iata, sum(n)::BIGINT AS flights
        FROM tally, airports x, airports y WHERE x.airport_id = o AND y.airport_id = d
        GROUP BY ALL ORDER BY flights DESC, origin_iata, dest_iata LIMIT 20)"""


@query("get_busiest_od_pairs", "P-11", W(f"WITH {_OD.strip()} SELECT * FROM odp", "flights", "airports"))
def _p11(fx):
    return P.get_busiest_od_pairs(fx.flights_base, fx.airports)


_GEO = """
tally AS (SELECT origin_airport_id AS o, destination_airport_id AS d, count(*) AS n FROM flights GROUP BY ALL),
spots AS (SELECT airport_id, iata_code AS code, latitude::DOUBLE AS lat, longitude::DOUBLE AS lon
          FROM airports WHERE latitude + longitude IS NOT NULL),
geo AS (SELECT x.code AS origin_iata, x.lat AS origin_lat, x.lon AS origin_lon,
               y.code AS dest_iata, y.lat AS dest_lat, y.lon AS dest_lon, sum(n)::BIGINT AS flights
        FROM tally, spots x, spots y WHERE x.airport_id = o AND y.airport_id = d
        GROUP BY ALL ORDER BY flights DESC, origin_iata, dest_iata LIMIT 50)"""


@query("get_route_geometries", "P-12", W(f"WITH {_GEO.strip()} SELECT * FROM geo", "flights", "airports"))
def _p12(fx):
    return P.get_route_geometries(fx.flights_base, fx.airports)


@query("clv_describe", "P-13", W(f"""
WITH {_CLV.strip()}
SELECT count(clv_usd) AS count, cast(sum(clv_usd) AS double) / count(clv_usd) AS mean,
       sqrt(greatest((cast(sum(clv_usd * clv_usd) AS double)
                      - cast(sum(clv_usd) AS double) * cast(sum(clv_usd) AS double) / count(clv_usd))
                     / CASE WHEN count(clv_usd) > 1 THEN count(clv_usd) - 1 END, 0.0)) AS std,
       cast(min(clv_usd) AS double) AS min,
       quantile_cont(cast(clv_usd AS double), 0.25) AS p25, quantile_cont(cast(clv_usd AS double), 0.5) AS p50,
       quantile_cont(cast(clv_usd AS double), 0.75) AS p75, cast(max(clv_usd) AS double) AS max
FROM clv""", "bookings", "payments"))
def _p13(fx):
    return P.clv_describe(_clv(fx))


@query("top_share", "P-14", W(f"""
WITH {_CLV.strip()}, {_TOP.strip()}
SELECT cast((SELECT sum(clv_usd) FROM top) AS double) / cast((SELECT sum(clv_usd) FROM clv) AS double)
  AS top_share""", "bookings", "payments"))
def _p14(fx):
    return P.top_share(_clv(fx))


@query("delay_histogram", "P-15", W("""
WITH x AS (SELECT cast(delay_minutes AS double) AS x FROM flights WHERE delay_minutes IS NOT NULL),
mm AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
b AS (SELECT coalesce(least(floor((x - lo) / CASE WHEN (hi - lo) / 30 > 0 THEN (hi - lo) / 30 END), 29), 0)
             AS bin FROM x, mm),
c AS (SELECT cast(bin AS integer) AS bin, count(*) AS n FROM b GROUP BY 1),
grid AS (SELECT cast(range AS integer) AS bin FROM range(30))
SELECT g.bin, lo + (hi - lo) * g.bin / 30 AS bin_start, lo + (hi - lo) * (g.bin + 1) / 30 AS bin_end,
       coalesce(c.n, 0) AS count
FROM grid g CROSS JOIN mm LEFT JOIN c ON c.bin = g.bin ORDER BY g.bin""", "flights"))
def _p15(fx):
    return P.histogram(fx.flights_base, "delay_minutes", 30)


@query("top_n_reliable", "P-16", W("""
WITH p AS (SELECT airline_iata,
                  CASE WHEN sum(arrivals) > 0 THEN sum(total_arrival_delay_min) / sum(arrivals) END AS avg_delay_min
           FROM flight_performance GROUP BY airline_iata)
SELECT * FROM (SELECT 'most_reliable' AS "group", airline_iata, avg_delay_min FROM p
               ORDER BY avg_delay_min ASC NULLS LAST, airline_iata LIMIT 3)
UNION ALL
SELECT * FROM (SELECT 'least_reliable', airline_iata, avg_delay_min FROM p
               ORDER BY avg_delay_min DESC NULLS LAST, airline_iata LIMIT 3)""", "flight_performance"))
def _p16(fx):
    return P.top_n_reliable(P.get_airline_punctuality(fx.flight_performance))


@query("sankey_links", "P-17", W(f"""
WITH {_OD.strip()},
nodes AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS node FROM (
  SELECT origin_iata AS label FROM odp UNION SELECT dest_iata FROM odp) t)
SELECT odp.origin_iata, odp.dest_iata, s.node AS source, t.node AS target, odp.flights AS value
FROM odp JOIN nodes s ON s.label = odp.origin_iata JOIN nodes t ON t.label = odp.dest_iata""",
    "flights", "airports"))
def _p17(fx):
    return P.sankey_links(P.get_busiest_od_pairs(fx.flights_base, fx.airports))


@query("flow_points", "P-18", W(f"""
WITH {_GEO.strip()}
SELECT 'origin' AS "end", origin_iata AS iata_code, origin_lat AS lat, origin_lon AS lon FROM geo
UNION ALL SELECT 'dest', dest_iata, dest_lat, dest_lon FROM geo""", "flights", "airports"))
def _p18(fx):
    return P.flow_points(P.get_route_geometries(fx.flights_base, fx.airports))


@query("clv_lorenz", "P-19", W(f"""
WITH {_CLV.strip()}
SELECT passenger_id, cast(clv_usd AS double) AS clv_usd,
       row_number() OVER (ORDER BY clv_usd, passenger_id) / (SELECT count(*) FROM clv) AS customer_share,
       cast(sum(clv_usd) OVER (ORDER BY clv_usd, passenger_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS double) / cast((SELECT sum(clv_usd) FROM clv) AS double) AS revenue_share
FROM clv""", "bookings", "payments"))
def _p19(fx):
    return P.clv_lorenz(_clv(fx))


@query("top_n_customers", "P-20", W(f"""
WITH {_CLV.strip()}
SELECT passenger_id, cast(clv_usd AS double) AS clv_usd FROM clv ORDER BY clv_usd DESC, passenger_id LIMIT 10""",
    "bookings", "payments"))
def _p20(fx):
    return P.top_n_customers(_clv(fx))
