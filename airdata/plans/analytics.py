"""Catalogue entries for the aggregation/join analytics (A-01..A-08, A-18, A-19)."""

from __future__ import annotations

from airdata.operators import metrics as M
from airdata.plans.registry import query
from airdata.plans.views_sql import with_views as W


@query("busiest_airports", "A-01", W("""
WITH ends AS (
  SELECT unnest([origin_airport_id, destination_airport_id]) AS airport_id, unnest([true, false]) AS leaves FROM flights)
SELECT airport_id, any_value(name) AS airport_name, any_value(iata_code) AS airport_iata,
       count_if(leaves)::BIGINT AS total_departures, count_if(NOT leaves)::BIGINT AS total_arrivals, count(*) AS total_movements
FROM ends JOIN airports USING (airport_id) GROUP BY airport_id
ORDER BY total_movements DESC, airport_iata NULLS LAST, airport_id LIMIT 10""", "flights", "airports"))
def _busiest_airports(fx):
    return M.busiest_airports(fx.flights_base, fx.airports)


@query("airline_on_time", "A-02", W("""
SELECT any_value(airline_id) AS airline_id, any_value(name) AS airline_name, any_value(iata_code) AS iata_code,
       sum(arrivals)::BIGINT AS total_arrivals, sum(arrivals_delayed_15min)::BIGINT AS delayed_arrivals,
       sum(arr_cancelled)::BIGINT AS cancelled_arrivals,
       delayed_arrivals / nullif(greatest(total_arrivals, 0), 0) AS pct_delayed,
       cancelled_arrivals / nullif(greatest(total_arrivals, 0), 0) AS pct_cancelled,
       sum(total_arrival_delay_min) / nullif(greatest(total_arrivals, 0), 0) AS avg_delay_minutes
FROM flight_performance f LEFT JOIN airlines ON iata_code = airline_iata
GROUP BY airline_iata ORDER BY avg_delay_minutes DESC NULLS LAST""", "flight_performance", "airlines"))
def _airline_on_time(fx):
    return M.airline_on_time(fx.flight_performance, fx.airlines)


@query("monthly_passengers", "A-03", W("""
SELECT cast(date_trunc('month', booking_date) AS date) AS month_start,
       count(*) AS total_bookings, count(DISTINCT passenger_id) AS unique_passengers
FROM bookings GROUP BY 1 ORDER BY 1""", "bookings"))
def _monthly_passengers(fx):
    return M.monthly_passengers(fx.bookings)


@query("loyalty_tier_transitions", "A-04", W("""
SELECT tier AS current_tier,
       (['Basic', 'Silver', 'Gold', 'Platinum'])[1 + (m >= 25000)::INT + (m >= 50000)::INT + (m >= 100000)::INT] AS target_tier,
       count(*) AS member_count
FROM (SELECT tier, coalesce(earned, 0) AS m FROM loyalty_accounts
      LEFT JOIN (SELECT loyalty_id, sum(miles_delta) AS earned FROM miles_transactions GROUP BY ALL) USING (loyalty_id))
GROUP BY ALL""", "loyalty_accounts", "miles_transactions"))
def _loyalty_tier_transitions(fx):
    return M.loyalty_tier_transitions(fx.loyalty_accounts, fx.miles_transactions)


@query("revenue_by_fare_class", "A-05", W("""
WITH r AS (
  SELECT b.fare_class, count(DISTINCT b.booking_id) AS num_bookings, sum(p.amount_usd) AS rev
  FROM bookings b JOIN payments p ON p.booking_id = b.booking_id GROUP BY b.fare_class)
SELECT fare_class, num_bookings, cast(rev AS double) AS total_revenue,
       CASE WHEN num_bookings > 0 THEN cast(rev AS double) / num_bookings END AS avg_revenue_per_booking
FROM r ORDER BY total_revenue DESC NULLS LAST""", "bookings", "payments"))
def _revenue_by_fare_class(fx):
    return M.revenue_by_fare_class(fx.bookings, fx.payments)


@query("flights_by_status", "A-06", W("""
SELECT status, count(*) AS total FROM flights GROUP BY status ORDER BY total DESC""", "flights"))
def _flights_by_status(fx):
    return M.flights_by_status(fx.flights_base)


@query("revenue_by_fare_class_success", "A-07", W("""
WITH good AS (SELECT booking_id, amount_usd FROM payments WHERE status NOT IN ('Refunded', 'Failed'))
SELECT fare_class, count(*) AS num_bookings, sum(amount_usd)::DOUBLE AS total_revenue,
       total_revenue / count(amount_usd) AS avg_revenue_per_booking
FROM good JOIN bookings USING (booking_id) GROUP BY ALL""", "bookings", "payments"))
def _revenue_by_fare_class_success(fx):
    return M.revenue_by_fare_class_success(fx.bookings, fx.payments)


@query("payment_success_by_channel", "A-18", W("""
WITH paid AS (SELECT booking_id, status ILIKE 'captured' OR status ILIKE 'authorized' AS fine FROM payments)
SELECT booking_channel, count(*) AS total_payments, count_if(fine)::BIGINT AS successful_payments,
       successful_payments / total_payments AS success_rate
FROM bookings JOIN paid USING (booking_id) GROUP BY ALL""", "bookings", "payments"))
def _payment_success_by_channel(fx):
    return M.payment_success_by_channel(fx.bookings, fx.payments)


@query("worst_routes", "A-19", W("""
WITH ends AS (
  SELECT route_id, o.iata_code AS origin_iata, d.iata_code AS destination_iata
  FROM routes, airports o, airports d WHERE o.airport_id = origin_airport_id AND d.airport_id = destination_airport_id)
SELECT route_id, any_value(origin_iata) AS origin_iata, any_value(destination_iata) AS destination_iata,
       count(*) AS total_flights, sum(delay_minutes) / nullif(count(delay_minutes), 0) AS avg_delay_minutes,
       count_if(status = 'Cancelled') / count(*) AS cancel_rate
FROM flights JOIN ends USING (route_id) GROUP BY route_id
ORDER BY avg_delay_minutes DESC NULLS LAST, cancel_rate DESC NULLS LAST, route_id LIMIT 25""", "flights", "routes", "airports"))
def _worst_routes(fx):
    return M.worst_routes(fx.flights, fx.routes, fx.airports)
