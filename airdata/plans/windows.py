"""Catalogue entries for window queries (A-09 .. A-14)."""

from __future__ import annotations

from airdata.operators import windows as Wn
from airdata.plans.registry import query
from airdata.plans.views_sql import with_views as W


@query("airline_delay_rank", "A-09", W("""
WITH late AS (
  SELECT airline_id, sum(delay_minutes) / nullif(count(delay_minutes), 0) AS mean FROM flights GROUP BY ALL)
SELECT airline_id, name AS airline_name, iata_code, mean AS avg_delay_minutes,
       (SELECT count(*) + 1 FROM late x WHERE x.airline_id IN (SELECT airline_id FROM airlines)
        AND (x.mean > late.mean OR x.mean IS NULL AND late.mean IS NOT NULL)) AS delay_rank
FROM late JOIN airlines USING (airline_id)""", "flights", "airlines"))
def _airline_delay_rank(fx):
    return Wn.airline_delay_rank(fx.flights_base, fx.airlines)


@query("running_monthly_revenue", "A-10", W("""
WITH by_month AS (SELECT date_trunc('month', paid_at)::DATE AS m, sum(amount_usd) AS usd FROM payments GROUP BY ALL)
SELECT a.m AS month_start, any_value(a.usd)::DOUBLE AS revenue, sum(b.usd)::DOUBLE AS running_cumulative_revenue
FROM by_month a JOIN by_month b ON b.m <= a.m GROUP BY a.m""", "payments"))
def _running_monthly_revenue(fx):
    return Wn.running_monthly_revenue(fx.payments)


@query("pct_delayed_by_month", "A-11", W("""
SELECT date_trunc('month', flight_date)::DATE AS month_start, count(*) AS total_flights,
       count_if(delay_minutes > 15)::BIGINT AS delayed_flights, delayed_flights / total_flights AS pct_delayed
FROM flights GROUP BY ALL""", "flights"))
def _pct_delayed_by_month(fx):
    return Wn.pct_delayed_by_month(fx.flights_base)


@query("clv_running", "A-12", W("""
SELECT passenger_id, paid_at::DATE AS paid_date, payment_id, amount_usd::DOUBLE AS amount_usd,
       (sum(amount_usd) OVER spent)::DOUBLE AS clv_to_date
FROM payments JOIN bookings USING (booking_id)
WINDOW spent AS (PARTITION BY passenger_id ORDER BY paid_at::DATE, payment_id ROWS UNBOUNDED PRECEDING)""", "bookings", "payments"))
def _clv_running(fx):
    return Wn.clv_running(fx.bookings, fx.payments)


@query("route_distance_rank", "A-13", W("""
WITH spots AS (
  SELECT airport_id, iata_code, latitude AS lat, longitude AS lon FROM airports WHERE latitude + longitude IS NOT NULL)
SELECT route_id, o.iata_code AS origin_iata, d.iata_code AS destination_iata,
       60 * sqrt(pow((d.lat - o.lat)::DOUBLE, 2) + pow((d.lon - o.lon)::DOUBLE, 2)) AS distance_nm,
       dense_rank() OVER (ORDER BY distance_nm DESC) AS distance_rank
FROM routes JOIN spots o ON origin_airport_id = o.airport_id JOIN spots d ON destination_airport_id = d.airport_id
ORDER BY distance_rank, origin_iata, destination_iata, route_id LIMIT 50""", "routes", "airports"))
def _route_distance_rank(fx):
    return Wn.route_distance_rank(fx.routes, fx.airports)


@query("top_loyalty_5pct", "A-14", W("""
WITH earned AS (SELECT loyalty_id, sum(miles_delta) AS miles FROM miles_transactions GROUP BY ALL),
placed AS (
  SELECT l.*, coalesce(miles, 0)::BIGINT AS lifetime_miles,
         coalesce((rank() OVER (ORDER BY coalesce(miles, 0)) - 1) / nullif(count(*) OVER () - 1, 0), 0.0) AS percentile_rank
  FROM loyalty_accounts l LEFT JOIN earned USING (loyalty_id))
SELECT loyalty_id, passenger_id, tier, miles_balance, lifetime_miles, percentile_rank
FROM placed WHERE percentile_rank >= 0.95""", "loyalty_accounts", "miles_transactions"))
def _top_loyalty_5pct(fx):
    return Wn.top_loyalty_5pct(fx.loyalty_accounts, fx.miles_transactions)
