"""Analytical queries: aggregation and join shapes (A-01 .. A-08, A-18, A-19).

Pattern throughout: aggregate the fact first (partial/map-side aggregation
absorbs hot keys such as hub airports), then join the much smaller aggregate
to dimensions, then top-k (``TakeOrderedAndProject``). No join fans out a fact
before aggregating. Money is summed in decimal, converted to double at the
end; ratios are one IEEE division of exact inputs so engines agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airdata.functions.numeric import count_if, ratio, to_double

SUCCESS_STATUSES = ("Captured", "Authorized")


def fact_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join two fact tables on their shared key as a sort-merge join.

    Both sides grow with the data, so neither may be broadcast just because a
    test-sized copy is under the threshold. In the loaded warehouse the pairs
    are bucketed and sorted on the key, so the merge join reads co-located
    buckets and shuffles nothing."""
    return left.join(right.hint("merge"), on, how)


def airport_movements(flights: DataFrame) -> DataFrame:
    """Departures and arrivals per airport in one scan and one shuffle:
    each flight emits (origin, 1, 0) and (destination, 0, 1)."""
    ends = F.explode(F.array(
        F.struct(F.col("origin_airport_id").alias("airport_id"),
                 F.lit(1).alias("dep"), F.lit(0).alias("arr")),
        F.struct(F.col("destination_airport_id").alias("airport_id"),
                 F.lit(0).alias("dep"), F.lit(1).alias("arr"))))
    return (flights.select(ends.alias("e")).select("e.*")
                   .groupBy("airport_id")
                   .agg(F.sum("dep").cast("bigint").alias("total_departures"),
                        F.sum("arr").cast("bigint").alias("total_arrivals"))
                   .withColumn("total_movements",
                               F.col("total_departures") + F.col("total_arrivals")))


def busiest_airports(flights: DataFrame, airports: DataFrame, limit: int = 10) -> DataFrame:
    """A-01: top airports by departures + arrivals (ties: iata, id)."""
    ap = airports.select("airport_id", F.col("name").alias("airport_name"),
                         F.col("iata_code").alias("airport_iata"))
    return (airport_movements(flights).join(ap, "airport_id")
            .select("airport_id", "airport_name", "airport_iata", "total_departures",
                    "total_arrivals", "total_movements")
            .orderBy(F.col("total_movements").desc(), F.col("airport_iata").asc_nulls_last(),
                     "airport_id")
            .limit(limit))


def _perf_sums(flight_performance: DataFrame) -> DataFrame:
    return (flight_performance.groupBy("airline_iata")
            .agg(F.sum("arrivals").cast("bigint").alias("total_arrivals"),
                 F.sum("arrivals_delayed_15min").cast("bigint").alias("delayed_arrivals"),
                 F.sum("arr_cancelled").cast("bigint").alias("cancelled_arrivals"),
                 F.sum("arr_diverted").cast("bigint").alias("diverted_arrivals"),
                 F.sum("total_arrival_delay_min").alias("total_delay_min")))


def airline_on_time(flight_performance: DataFrame, airlines: DataFrame) -> DataFrame:
    """A-02: per-carrier sums, delayed/cancelled shares and average delay,
    left-joined to airline names after aggregating."""
    perf = _perf_sums(flight_performance)
    has = F.col("total_arrivals") > 0
    al = airlines.select("airline_id", F.col("name").alias("airline_name"), "iata_code")
    return (perf.join(al, perf.airline_iata == al.iata_code, "left")
            .select("airline_id", "airline_name", "iata_code", "total_arrivals",
                    "delayed_arrivals", "cancelled_arrivals",
                    F.when(has, ratio(F.col("delayed_arrivals"), F.col("total_arrivals"))).alias("pct_delayed"),
                    F.when(has, ratio(F.col("cancelled_arrivals"), F.col("total_arrivals"))).alias("pct_cancelled"),
                    F.when(has, F.col("total_delay_min") / F.col("total_arrivals")).alias("avg_delay_minutes"))
            .orderBy(F.col("avg_delay_minutes").desc_nulls_last(), "iata_code"))


def month_start(ts_col) -> F.Column:
    """``date_trunc('month', ts)::date``."""
    c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return F.trunc(c.cast("date"), "MM")


def monthly_passengers(bookings: DataFrame) -> DataFrame:
    """A-03: bookings and distinct passengers per month."""
    return (bookings.groupBy(month_start("booking_date").alias("month_start"))
            .agg(F.count(F.lit(1)).alias("total_bookings"),
                 F.countDistinct("passenger_id").alias("unique_passengers"))
            .orderBy("month_start"))


TIER_ORDER = ("Basic", "Silver", "Gold", "Platinum")


def tier_ordinal(col) -> F.Column:
    """Enum sort position of a loyalty tier (Basic < Silver < Gold < Platinum)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_position(F.array(*[F.lit(t) for t in TIER_ORDER]), c)


def lifetime_miles(loyalty_accounts: DataFrame, miles_transactions: DataFrame) -> DataFrame:
    """Net lifetime miles per account: miles are summed per account *before*
    the join, so the join is 1:1 and never multiplies account rows."""
    sums = miles_transactions.groupBy("loyalty_id").agg(F.sum("miles_delta").alias("_miles"))
    return (fact_join(loyalty_accounts, sums, "loyalty_id", "left")
            .withColumn("lifetime_miles", F.coalesce(F.col("_miles"), F.lit(0)).cast("bigint"))
            .drop("_miles"))


def target_tier(miles) -> F.Column:
    m = F.col(miles) if isinstance(miles, str) else miles
    return (F.when(m < 25000, "Basic").when(m < 50000, "Silver")
             .when(m < 100000, "Gold").otherwise("Platinum"))


def loyalty_tier_transitions(loyalty_accounts: DataFrame, miles_transactions: DataFrame) -> DataFrame:
    """A-04: cross-tab of current tier vs miles-based target tier."""
    lm = lifetime_miles(loyalty_accounts, miles_transactions)
    return (lm.groupBy(F.col("tier").alias("current_tier"),
                       target_tier("lifetime_miles").alias("target_tier"))
              .agg(F.count(F.lit(1)).alias("member_count"))
              .orderBy(tier_ordinal("current_tier"), "target_tier"))


def _paid_bookings(bookings: DataFrame, payments: DataFrame, statuses=None) -> DataFrame:
    p = payments
    if statuses is not None:
        p = p.filter(F.col("status").isin(list(statuses)))
    return fact_join(bookings, p.select("booking_id", "amount_usd", "status", "paid_at",
                                        "payment_id"), "booking_id")


def revenue_by_fare_class(bookings: DataFrame, payments: DataFrame, statuses=None) -> DataFrame:
    """A-05: distinct bookings, revenue and revenue per booking by fare class
    (all payment statuses unless ``statuses`` is given).

    Payments are summed per booking first, so the join is 1:1 and
    ``COUNT(DISTINCT booking_id)`` becomes a plain count: no distinct
    aggregation (an extra shuffle of every joined row) is needed."""
    p = payments if statuses is None else payments.filter(F.col("status").isin(list(statuses)))
    per_booking = p.groupBy("booking_id").agg(F.sum("amount_usd").alias("_b_rev"))
    j = fact_join(bookings.select("booking_id", "fare_class"), per_booking, "booking_id")
    return (j.groupBy("fare_class")
            .agg(F.count(F.lit(1)).alias("num_bookings"), F.sum("_b_rev").alias("_rev"))
            .select("fare_class", "num_bookings",
                    to_double(F.col("_rev")).alias("total_revenue"),
                    F.when(F.col("num_bookings") > 0,
                           to_double(F.col("_rev")) / F.col("num_bookings")).alias("avg_revenue_per_booking"))
            .orderBy(F.col("total_revenue").desc_nulls_last(), "fare_class"))


def flights_by_status(flights: DataFrame) -> DataFrame:
    """A-06."""
    return (flights.groupBy("status").agg(F.count(F.lit(1)).alias("total"))
                   .orderBy(F.col("total").desc(), "status"))


def revenue_by_fare_class_success(bookings: DataFrame, payments: DataFrame,
                                  statuses=SUCCESS_STATUSES) -> DataFrame:
    """A-07: Captured + Authorized payments; COUNT(*) and AVG(amount)."""
    j = _paid_bookings(bookings.select("booking_id", "fare_class"), payments, statuses)
    return (j.groupBy("fare_class")
            .agg(F.count(F.lit(1)).alias("num_bookings"),
                 F.sum("amount_usd").alias("_rev"),
                 F.count("amount_usd").alias("_n"))
            .select("fare_class", "num_bookings", to_double(F.col("_rev")).alias("total_revenue"),
                    (to_double(F.col("_rev")) / F.col("_n")).alias("avg_revenue_per_booking"))
            .orderBy(F.col("total_revenue").desc(), "fare_class"))


def route_distance_summary(routes_with_distance: DataFrame) -> DataFrame:
    """A-08: count, non-null count, min and max of ``distance_nm``."""
    return routes_with_distance.agg(
        F.count(F.lit(1)).alias("total_routes"),
        F.count("distance_nm").alias("routes_with_distance"),
        F.min("distance_nm").alias("min_distance"),
        F.max("distance_nm").alias("max_distance"))


def payment_success_by_channel(bookings: DataFrame, payments: DataFrame,
                               success=SUCCESS_STATUSES) -> DataFrame:
    """A-18: share of payments whose status (case-insensitive) is a success."""
    ok = F.lower(F.col("status")).isin([s.lower() for s in success])
    j = _paid_bookings(bookings.select("booking_id", "booking_channel"), payments)
    return (j.groupBy("booking_channel")
            .agg(F.count(F.lit(1)).alias("total_payments"),
                 F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("successful_payments"))
            .withColumn("success_rate", ratio(F.col("successful_payments"), F.col("total_payments")))
            .orderBy(F.col("success_rate").desc_nulls_last(), "booking_channel"))


def route_metrics(flights: DataFrame) -> DataFrame:
    """Per-route flight count, average delay and cancel rate (routed flights only)."""
    return (flights.filter(F.col("route_id").isNotNull())
            .groupBy("route_id")
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 F.sum("delay_minutes").alias("_dsum"),
                 F.count("delay_minutes").alias("_dn"),
                 count_if(F.col("status") == "Cancelled").alias("_cancelled"))
            .withColumn("avg_delay_minutes", ratio(F.col("_dsum"), F.col("_dn")))
            .withColumn("cancel_rate", ratio(F.col("_cancelled"), F.col("total_flights"))))


def with_endpoint_iata(routes: DataFrame, airports: DataFrame,
                       origin_name="origin_iata", dest_name="destination_iata") -> DataFrame:
    """Attach origin and destination IATA codes (inner joins, as the reference)."""
    ao = airports.select(F.col("airport_id").alias("origin_airport_id"),
                         F.col("iata_code").alias(origin_name))
    ad = airports.select(F.col("airport_id").alias("destination_airport_id"),
                         F.col("iata_code").alias(dest_name))
    return routes.join(ao, "origin_airport_id").join(ad, "destination_airport_id")


def worst_routes(flights: DataFrame, routes: DataFrame, airports: DataFrame,
                 limit: int = 25) -> DataFrame:
    """A-19: routes by average delay then cancel rate, top ``limit``.

    Flights are aggregated to one row per route before any join; only the
    route-grain table meets the dimensions."""
    rm = route_metrics(flights)
    r = with_endpoint_iata(routes.select("route_id", "origin_airport_id",
                                         "destination_airport_id"), airports)
    return (rm.join(r, "route_id")
            .select("route_id", "origin_iata", "destination_iata", "total_flights",
                    "avg_delay_minutes", "cancel_rate")
            .orderBy(F.col("avg_delay_minutes").desc_nulls_last(),
                     F.col("cancel_rate").desc_nulls_last(), "route_id")
            .limit(limit))
