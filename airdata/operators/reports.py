"""Report helpers of the analytics notebook layer (P-01 .. P-20).

In the source these return pandas frames and finish work on the client
(``head``, ``describe``, ``sort_values``). Here each is a lazy DataFrame and
that client-side work is part of the plan: limits are pushed into
``TakeOrderedAndProject``, top-percent cuts use distributed positions,
quantiles use ``order_statistics``, cumulative shares use ``prefix_sum``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airdata.functions.scalar import with_scalar
from airdata.functions.numeric import count_if, pct, ratio, round_half_up, to_double
from airdata.operators.keys import assign_surrogate_key
from airdata.operators.metrics import (_perf_sums, fact_join, month_start, route_metrics,
                                      with_endpoint_iata)
from airdata.operators.scan import order_statistics, prefix_sums, quantiles_of, value_counts

CAPTURED = ("Captured",)


def _captured(bookings, payments, cols):
    p = payments.filter(F.col("status").isin(list(CAPTURED))).select("booking_id", "amount_usd", "status")
    return fact_join(bookings.select("booking_id", *cols), p, "booking_id")


def get_revenue_by_fare_class(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """P-01: Captured payments by fare class; average rounded to cents."""
    j = _captured(bookings, payments, ["fare_class"])
    return (j.groupBy("fare_class")
            .agg(F.count(F.lit(1)).alias("bookings"), F.sum("amount_usd").alias("_rev"))
            .select("fare_class", "bookings", to_double(F.col("_rev")).alias("revenue_usd"),
                    round_half_up(ratio(F.col("_rev"), F.col("bookings")), 2).alias("avg_revenue_per_booking"))
            .orderBy(F.col("revenue_usd").desc(), "fare_class"))


def get_monthly_revenue(payments: DataFrame) -> DataFrame:
    """P-02: Captured revenue per month."""
    return (payments.filter(F.col("status").isin(list(CAPTURED)))
            .groupBy(month_start("paid_at").alias("month"))
            .agg(to_double(F.sum("amount_usd")).alias("revenue_usd"))
            .orderBy("month"))


def get_payment_success_by_channel(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """P-03: share of Captured payments per channel, in percent."""
    j = fact_join(bookings.select("booking_id", "booking_channel"),
                  payments.select("booking_id", "status"), "booking_id")
    return (j.groupBy("booking_channel")
            .agg(F.count(F.lit(1)).alias("total_payments"),
                 count_if(F.col("status") == "Captured").alias("successful_payments"))
            .withColumn("success_rate_pct", pct(F.col("successful_payments"), F.col("total_payments")))
            .orderBy(F.col("success_rate_pct").desc(), "booking_channel"))


def flights_per_airport(flights: DataFrame) -> DataFrame:
    """Flights touching each airport (origin OR destination; a flight with
    origin = destination counts once). The OR join of the source becomes an
    explode of the distinct endpoints plus an equi-join: no nested-loop join."""
    ends = F.explode(F.array_distinct(F.array("origin_airport_id", "destination_airport_id")))
    return (flights.select(ends.alias("airport_id"))
                   .groupBy("airport_id").agg(F.count(F.lit(1)).alias("flight_count")))


def get_busiest_airports(flights: DataFrame, airports: DataFrame, limit: int = 10) -> DataFrame:
    """P-04: top airports by flights touching them."""
    ap = airports.select("airport_id", "iata_code", "name")
    return (flights_per_airport(flights).join(ap, "airport_id")
            .select("airport_id", "iata_code", "name", "flight_count")
            .orderBy(F.col("flight_count").desc(), "airport_id").limit(limit))


def get_airline_punctuality(flight_performance: DataFrame) -> DataFrame:
    """P-05: per-carrier BTS totals and average delay (ascending, nulls last)."""
    s = _perf_sums(flight_performance)
    return (s.select("airline_iata", "total_arrivals", F.col("delayed_arrivals").alias("delayed_15min"),
                     F.col("cancelled_arrivals").alias("cancelled"),
                     F.col("diverted_arrivals").alias("diverted"), "total_delay_min",
                     F.when(F.col("total_arrivals") > 0,
                            F.col("total_delay_min") / F.col("total_arrivals")).alias("avg_delay_min"))
             .orderBy(F.col("avg_delay_min").asc_nulls_last(), "airline_iata"))


def get_clv(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """P-06: Captured spend per passenger (decimal)."""
    j = _captured(bookings, payments, ["passenger_id"])
    return j.groupBy("passenger_id").agg(F.sum("amount_usd").alias("clv_usd"))


def clv_ranked(clv: DataFrame) -> DataFrame:
    """CLV rows with their 1-based position in descending CLV order (ties by
    passenger id), assigned without a one-task window."""
    return assign_surrogate_key(clv.withColumn("_neg", -F.col("clv_usd")),
                                ["_neg", "passenger_id"], "clv_rank").drop("_neg")


def get_top_customers(clv: DataFrame, pct_: float = 0.05) -> DataFrame:
    """P-07: the top ``max(1, floor(n * pct))`` customers by CLV. The value of
    the last of them is an exact order statistic; only customers at or above it
    are ranked."""
    clv = clv.checkpoint()   # a row a customer: the payments are summed once
    cut = order_statistics(value_counts(clv, "clv_usd"), {"_last": F.col("_n") - _top_k(F.col("_n"), pct_)}, below=True).select("_last", "_n")
    last, n = cut.first()   # one row of two numbers
    k = _top_k(F.lit(n), pct_)
    return clv_ranked(clv.filter(F.col("clv_usd") >= F.lit(last))).filter(F.col("clv_rank") <= k)


def _top_k(n, pct_: float):
    return F.greatest(F.lit(1), F.floor(n * F.lit(pct_)))


def get_worst_routes(flights: DataFrame, routes: DataFrame, airports: DataFrame,
                     limit: int = 10) -> DataFrame:
    """P-08: routes by rounded average delay (desc, nulls last)."""
    rm = route_metrics(flights)
    r = with_endpoint_iata(routes.select("route_id", "origin_airport_id", "destination_airport_id"),
                           airports, "origin_iata", "dest_iata")
    return (rm.join(r, "route_id")
            .select("route_id", "origin_iata", "dest_iata", F.col("total_flights").alias("flights"),
                    round_half_up(F.col("avg_delay_minutes"), 2).alias("avg_delay_min"),
                    pct(F.col("_cancelled"), F.col("total_flights")).alias("cancel_rate_pct"))
            .orderBy(F.col("avg_delay_min").desc_nulls_last(), "route_id").limit(limit))


def get_delay_by_month(flights: DataFrame) -> DataFrame:
    """P-09: percent of flights delayed > 15 min per month."""
    return (flights.filter(F.col("flight_date").isNotNull())
            .groupBy(month_start("flight_date").alias("month"))
            .agg(pct(count_if(F.col("delay_minutes") > 15), F.count(F.lit(1))).alias("pct_delayed"))
            .orderBy("month"))


def get_airports_for_map(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """P-10: distinct airports used by a flight, with coordinates. A semi
    join against the flights' distinct endpoints replaces the OR join."""
    used = flights_per_airport(flights).select("airport_id")
    return (airports.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .join(used, "airport_id", "left_semi")
            .select("airport_id", "iata_code", "name", "country", to_double(F.col("latitude")).alias("latitude"),
                    to_double(F.col("longitude")).alias("longitude")))


def _od_counts(flights: DataFrame) -> DataFrame:
    # aggregate on ids first (one shuffle of the fact), names come after
    return (flights.groupBy("origin_airport_id", "destination_airport_id")
                   .agg(F.count(F.lit(1)).alias("_n")))


def get_busiest_od_pairs(flights: DataFrame, airports: DataFrame, limit: int = 20) -> DataFrame:
    """P-11: flights per (origin IATA, destination IATA), top ``limit``.
    Counted per id pair first, then regrouped by code (codes may repeat)."""
    od = with_endpoint_iata(_od_counts(flights), airports, "origin_iata", "dest_iata")
    return (od.groupBy("origin_iata", "dest_iata").agg(F.sum("_n").cast("bigint").alias("flights"))
              .orderBy(F.col("flights").desc(), "origin_iata", "dest_iata").limit(limit))


def get_route_geometries(flights: DataFrame, airports: DataFrame, limit: int = 50) -> DataFrame:
    """P-12: top OD pairs with both endpoints' coordinates."""
    ao = airports.select(F.col("airport_id").alias("origin_airport_id"),
                         F.col("iata_code").alias("origin_iata"),
                         F.col("latitude").alias("origin_lat"), F.col("longitude").alias("origin_lon"))
    ad = airports.select(F.col("airport_id").alias("destination_airport_id"),
                         F.col("iata_code").alias("dest_iata"),
                         F.col("latitude").alias("dest_lat"), F.col("longitude").alias("dest_lon"))
    j = _od_counts(flights).join(ao, "origin_airport_id").join(ad, "destination_airport_id")
    for c in ("origin_lat", "origin_lon", "dest_lat", "dest_lon"):
        j = j.filter(F.col(c).isNotNull())
    keys = ["origin_iata", "origin_lat", "origin_lon", "dest_iata", "dest_lat", "dest_lon"]
    g = j.groupBy(*keys).agg(F.sum("_n").cast("bigint").alias("flights"))
    return (g.select("origin_iata", to_double(F.col("origin_lat")).alias("origin_lat"),
                     to_double(F.col("origin_lon")).alias("origin_lon"), "dest_iata",
                     to_double(F.col("dest_lat")).alias("dest_lat"),
                     to_double(F.col("dest_lon")).alias("dest_lon"), "flights")
             .orderBy(F.col("flights").desc(), "origin_iata", "dest_iata").limit(limit))


def clv_describe(clv: DataFrame) -> DataFrame:
    """P-13: pandas ``describe()`` of CLV: count, mean, std (sample), min,
    quartiles (linear interpolation), max.

    The standard deviation comes from exact decimal sums of x and x^2 (one
    pass, order independent), so it is the same number however the rows are
    partitioned or merged; a streaming variance merged across partitions can
    differ in the last bits from run to run."""
    counts = value_counts(clv, "clv_usd")   # all that is wanted comes from it
    x, c = F.col("_v"), F.col("_c")
    n = F.sum(c)
    s1 = to_double(F.sum(x * c.cast("decimal(12,0)")))
    s2 = to_double(F.sum(x * x * c.cast("decimal(12,0)")))
    var = (s2 - s1 * s1 / n) / F.when(n > 1, n - 1)
    stats = counts.agg(F.coalesce(n, F.lit(0)).alias("count"), (s1 / n).alias("mean"),
                       F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"),
                       to_double(F.min(x)).alias("min"), to_double(F.max(x)).alias("max"))
    q = quantiles_of(counts, [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return with_scalar(stats, q).select("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def top_share(clv: DataFrame, pct_: float = 0.05) -> DataFrame:
    """P-14: revenue share of the top customers (P-07) in total CLV. Nobody is
    ranked: the customers above the last value count whole, and of those at it
    as many as are left."""
    counts = value_counts(clv, "clv_usd")
    k = _top_k(F.col("_n"), pct_)
    x = with_scalar(counts, order_statistics(counts, {"_last": F.col("_n") - k}))
    over, n = F.col("_v") > F.col("_last"), F.col("_c").cast("decimal(12,0)")
    s = x.agg(F.sum(F.col("_v") * n).alias("_all"), F.sum(F.when(over, F.col("_v") * n)).alias("_over"), F.sum(F.when(over, F.col("_c"))).alias("_many"),
              F.sum("_c").alias("_n"), F.max("_last").alias("_last"))
    left = k - F.coalesce(F.col("_many"), F.lit(0))
    top = F.coalesce(F.col("_over"), F.lit(0).cast("decimal(38,2)")) + left.cast("decimal(20,0)") * F.col("_last")
    return s.select((to_double(top) / to_double(F.col("_all"))).alias("top_share"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """P-15: equal-width histogram over [min, max], last bin closed (numpy
    semantics), zero-filled. min/max are a one-row aggregate; counting is a
    partial aggregate per bin."""
    x = df.select(to_double(F.col(col)).alias("_x")).filter(F.col("_x").isNotNull())
    mm = x.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    raw = F.floor((F.col("_x") - F.col("_lo")) / F.when(width > 0, width))
    b = F.coalesce(F.least(raw, F.lit(bins - 1)), F.lit(0)).cast("int")
    counts = (with_scalar(x, mm).select(b.alias("bin"))
                .groupBy("bin").agg(F.count(F.lit(1)).alias("_c")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    grid = with_scalar(grid, mm)
    edge = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / F.lit(bins)
    edge1 = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / F.lit(bins)
    return (grid.join(counts, "bin", "left")
                .select("bin", edge.alias("bin_start"), edge1.alias("bin_end"),
                        F.coalesce(F.col("_c"), F.lit(0)).cast("bigint").alias("count"))
                .orderBy("bin"))


def top_n_reliable(punctuality: DataFrame, n: int = 3) -> DataFrame:
    """P-16: the n carriers with the lowest and the n with the highest
    average delay (nulls last both ways, as pandas sorts NaN)."""
    best = (punctuality.orderBy(F.col("avg_delay_min").asc_nulls_last(), "airline_iata").limit(n)
            .select(F.lit("most_reliable").alias("group"), "airline_iata", "avg_delay_min"))
    worst = (punctuality.orderBy(F.col("avg_delay_min").desc_nulls_last(), "airline_iata").limit(n)
             .select(F.lit("least_reliable").alias("group"), "airline_iata", "avg_delay_min"))
    return best.unionByName(worst)


def sankey_links(od_pairs: DataFrame) -> DataFrame:
    """P-17: node index (codes sorted) and source/target/value per link, for
    the top-N OD pairs (a bounded frame: at most 2N nodes, so the window over
    nodes is tiny)."""
    nodes = (od_pairs.select(F.col("origin_iata").alias("label"))
             .union(od_pairs.select(F.col("dest_iata").alias("label"))).distinct())
    idx = nodes.select("label", (F.row_number().over(Window.orderBy("label")) - 1).cast("bigint").alias("node"))
    s = idx.select(F.col("label").alias("origin_iata"), F.col("node").alias("source"))
    t = idx.select(F.col("label").alias("dest_iata"), F.col("node").alias("target"))
    return (od_pairs.join(s, "origin_iata").join(t, "dest_iata")
            .select("origin_iata", "dest_iata", "source", "target", F.col("flights").alias("value")))


def flow_points(geometries: DataFrame) -> DataFrame:
    """P-18: all endpoint coordinates of the route geometries, origins then
    destinations (concatenated, duplicates kept)."""
    o = geometries.select(F.lit("origin").alias("end"), F.col("origin_iata").alias("iata_code"),
                          F.col("origin_lat").alias("lat"), F.col("origin_lon").alias("lon"))
    d = geometries.select(F.lit("dest").alias("end"), F.col("dest_iata").alias("iata_code"),
                          F.col("dest_lat").alias("lat"), F.col("dest_lon").alias("lon"))
    return o.unionByName(d)


def clv_lorenz(clv: DataFrame) -> DataFrame:
    """P-19: Lorenz curve of CLV: customers in ascending CLV order with
    cumulative customer share and cumulative revenue share (distributed
    prefix sums; no single-task window)."""
    c = clv.select("passenger_id", "clv_usd", F.lit(1).cast("bigint").alias("_one"))
    cum = prefix_sums(c, ["clv_usd", "passenger_id"], {"_one": "_k", "clv_usd": "_cum"})
    tot = clv.agg(F.count(F.lit(1)).alias("_n"), F.sum("clv_usd").alias("_t"))
    return (with_scalar(cum, tot)
            .select("passenger_id", to_double(F.col("clv_usd")).alias("clv_usd"),
                    (F.col("_k") / F.col("_n")).alias("customer_share"),
                    (to_double(F.col("_cum")) / to_double(F.col("_t"))).alias("revenue_share")))


def top_n_customers(clv: DataFrame, n: int = 10) -> DataFrame:
    """P-20: the first n rows of CLV in descending order (ties by id)."""
    return (clv.select("passenger_id", to_double(F.col("clv_usd")).alias("clv_usd"))
               .orderBy(F.col("clv_usd").desc(), "passenger_id").limit(n))
