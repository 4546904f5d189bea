"""Analytical queries with window functions (A-09 .. A-14).

Windows always run after the input has been shrunk: to one row per airline
(A-09), per month (A-10, A-11), or to the top-k (A-13). Row-grain windows
(A-12 running spend per passenger, A-14 percent rank over members) use the
skew-safe forms in ``airdata.operators.scan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airdata.functions.scalar import with_scalar
from airdata.operators.metrics import fact_join, lifetime_miles, month_start
from airdata.operators.scan import order_statistics, prefix_sum, running_sum, value_counts
from airdata.functions.numeric import ratio, to_double


def airline_delay_rank(flights: DataFrame, airlines: DataFrame) -> DataFrame:
    """A-09: average delay per airline and ``RANK() OVER (ORDER BY avg DESC)``
    with PostgreSQL's DESC order (NULLS FIRST). The window sees one row per
    airline."""
    per = (flights.groupBy("airline_id")
                  .agg(F.sum("delay_minutes").alias("_s"), F.count("delay_minutes").alias("_n")))
    al = airlines.select("airline_id", F.col("name").alias("airline_name"), "iata_code")
    avg = ratio(F.col("_s"), F.col("_n"))
    j = per.join(al, "airline_id").withColumn("avg_delay_minutes", avg)
    w = Window.orderBy(F.col("avg_delay_minutes").desc_nulls_first())
    return (j.select("airline_id", "airline_name", "iata_code", "avg_delay_minutes",
                     F.rank().over(w).cast("bigint").alias("delay_rank"))
             .orderBy("delay_rank", "airline_id"))


def monthly_revenue(payments: DataFrame, statuses=None, month_col="month_start",
                    revenue_col="revenue") -> DataFrame:
    p = payments if statuses is None else payments.filter(F.col("status").isin(list(statuses)))
    return (p.groupBy(month_start("paid_at").alias(month_col))
             .agg(F.sum("amount_usd").alias(revenue_col)))


def running_monthly_revenue(payments: DataFrame) -> DataFrame:
    """A-10: monthly revenue and its running total (all statuses). The
    window runs over months only."""
    m = monthly_revenue(payments, None, "month_start", "_rev")
    w = Window.orderBy("month_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (m.select("month_start", to_double(F.col("_rev")).alias("revenue"),
                     to_double(F.sum("_rev").over(w)).alias("running_cumulative_revenue"))
             .orderBy("month_start"))


def pct_delayed_by_month(flights: DataFrame) -> DataFrame:
    """A-11: share of flights with delay > 15 min per month (null delay counts
    as not delayed)."""
    return (flights.groupBy(month_start("flight_date").alias("month_start"))
            .agg(F.count(F.lit(1)).alias("total_flights"),
                 F.sum(F.when(F.col("delay_minutes") > 15, 1).otherwise(0)).cast("bigint")
                  .alias("delayed_flights"))
            .withColumn("pct_delayed", ratio(F.col("delayed_flights"), F.col("total_flights")))
            .orderBy("month_start"))


def clv_running(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """A-12: cumulative spend per passenger ordered by payment date (ties by
    payment id). A heavy passenger is spread over many tasks."""
    cp = (fact_join(bookings.select("booking_id", "passenger_id"),
                    payments.select("booking_id", "payment_id", "paid_at", "amount_usd"),
                    "booking_id")
                  .select("passenger_id", "payment_id",
                          F.col("paid_at").cast("date").alias("paid_date"), "amount_usd"))
    rs = running_sum(cp, ["passenger_id"], ["paid_date", "payment_id"], "amount_usd", "_clv")
    # Row-grain result: no global ORDER BY (a full range shuffle of every
    # payment); callers that present it sort what they show.
    return rs.select("passenger_id", "paid_date", "payment_id",
                     to_double(F.col("amount_usd")).alias("amount_usd"),
                     to_double(F.col("_clv")).alias("clv_to_date"))


def planar_distance(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """sqrt(dlat^2 + dlon^2) * 60 for routes whose endpoints have coordinates."""
    ao = airports.select(F.col("airport_id").alias("origin_airport_id"),
                         F.col("iata_code").alias("origin_iata"),
                         F.col("latitude").alias("_olat"), F.col("longitude").alias("_olon"))
    ad = airports.select(F.col("airport_id").alias("destination_airport_id"),
                         F.col("iata_code").alias("destination_iata"),
                         F.col("latitude").alias("_dlat"), F.col("longitude").alias("_dlon"))
    coords = ["_olat", "_olon", "_dlat", "_dlon"]
    j = routes.join(ao, "origin_airport_id").join(ad, "destination_airport_id")
    for c in coords:
        j = j.filter(F.col(c).isNotNull())
    dist = F.sqrt(F.pow((F.col("_dlat") - F.col("_olat")).cast("double"), 2)
                  + F.pow((F.col("_dlon") - F.col("_olon")).cast("double"), 2)) * 60
    return j.withColumn("distance_nm", dist).drop(*coords)


def route_distance_rank(routes: DataFrame, airports: DataFrame, limit: int = 50) -> DataFrame:
    """A-13: longest routes by planar distance with ``DENSE_RANK``.

    Top-k first (``TakeOrderedAndProject``), then the rank over those ``limit``
    rows: a dense rank depends only on the rows above, which the top-k keeps,
    so the result equals rank-then-limit without a one-task global window."""
    rd = planar_distance(routes.select("route_id", "origin_airport_id",
                                       "destination_airport_id"), airports)
    top = (rd.select("route_id", "origin_iata", "destination_iata", "distance_nm")
             .orderBy(F.col("distance_nm").desc(), "origin_iata", "destination_iata", "route_id")
             .limit(limit))
    w = Window.orderBy(F.col("distance_nm").desc())
    return (top.withColumn("distance_rank", F.dense_rank().over(w).cast("bigint"))
               .orderBy("distance_rank", "origin_iata", "destination_iata", "route_id"))


def percent_rank_at_least(df: DataFrame, value: str, threshold: float,
                          out: str = "percentile_rank") -> DataFrame:
    """Rows whose ``PERCENT_RANK() OVER (ORDER BY value)`` >= threshold, with
    the rank attached.

    percent_rank = (rows strictly below) / (n - 1); ties share the lowest.
    Computed on the per-value count table (partial aggregation absorbs hot
    values). The rank is monotone in the value, so an order statistic a place
    below the threshold cuts the values and the rows; only the values above it
    are summed up in order, from the number of rows below. n = 1 gives 0 as in SQL.
    """
    counts = value_counts(df, value)
    at = F.greatest(F.floor(F.lit(threshold) * (F.col("_n") - 1)) - 1, F.lit(0))
    cut = order_statistics(counts, {"_cut": at}, below=True)
    # the few values from the cut on, written once
    top = with_scalar(counts, cut).filter(F.col("_v") >= F.col("_cut")).checkpoint()
    below = F.col("_to") - F.col("_c") + F.col("_cut_below")
    ranks = (prefix_sum(top, ["_v"], "_c", "_to")
             .withColumn(out, F.coalesce(below.cast("double") / F.when(F.col("_n") > 1, (F.col("_n") - 1).cast("double")), F.lit(0.0)))
             .filter(F.col(out) >= F.lit(threshold)).select(F.col("_v").alias(value), out))
    rows = df.filter(F.col(value) >= top.agg(F.min("_v")).scalar())
    return rows.join(ranks, value)


def top_loyalty_5pct(loyalty_accounts: DataFrame, miles_transactions: DataFrame,
                     threshold: float = 0.95) -> DataFrame:
    """A-14: members in the top 5% by lifetime miles (PERCENT_RANK >= 0.95)."""
    # a row an account, written once: the miles are summed once
    lm = lifetime_miles(loyalty_accounts, miles_transactions).checkpoint()
    return (percent_rank_at_least(lm, "lifetime_miles", threshold)
            .select("loyalty_id", "passenger_id", "tier", "miles_balance", "lifetime_miles",
                    "percentile_rank")
            .orderBy(F.col("lifetime_miles").desc(), "loyalty_id"))


__all__ = [
    "airline_delay_rank", "running_monthly_revenue", "pct_delayed_by_month", "clv_running",
    "route_distance_rank", "top_loyalty_5pct", "percent_rank_at_least", "planar_distance",
    "monthly_revenue",
]
