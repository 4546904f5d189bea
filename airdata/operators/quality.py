"""Data-quality queries (Q-01 .. Q-17).

Scale notes
-----------
- Orphan counts aggregate the child by its foreign-key value first (partial
  aggregation, so a hot key costs nothing extra) and only the distinct key
  values meet the parent in an anti join.
- Wide one-row reports attach one-row aggregates as scalar subqueries.
- The exact median (Q-17) counts by value around a sketched bracket, not in a
  single-buffer ``percentile`` aggregate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airdata.functions.scalar import with_scalar
from airdata.operators.constraints import key_issues
from airdata.operators.scan import quantiles_of, value_counts
from airdata.functions.numeric import to_double


def _union(frames):
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Q-01: one row per table with its row count."""
    return _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count")
                   for name, df in tables.items()]).orderBy("table_name")


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                 null_is_orphan: bool = True, empty_as_null: bool = False) -> DataFrame:
    """One-row frame ``orphans``: child rows whose ``fk`` has no parent row.

    The child is first reduced to one row per distinct key value with its
    row count; only those values are anti-joined to the parent keys.
    ``null_is_orphan`` follows ``LEFT JOIN ... WHERE parent.pk IS NULL``
    (a null key never matches); ``empty_as_null`` follows ``SUM(CASE ...)``
    over an empty child (NULL instead of 0).
    """
    per_key = child.groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    if not null_is_orphan:
        per_key = per_key.filter(F.col("_k").isNotNull())
    keys = parent.select(F.col(pk).alias("_k"))
    missing = (per_key.join(keys, "_k", "left_anti")
                      .agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("orphans")))
    if not empty_as_null:
        return missing
    total = per_key.agg(F.sum("_c").alias("_total"))
    return (with_scalar(missing, total)
                   .select(F.when(F.col("_total").isNotNull(), F.col("orphans")).alias("orphans")))


FK_ORPHAN_CHECKS = (
    # (output column, child table, fk, parent table, pk)
    ("flights_missing_airline", "flights", "airline_id", "airlines", "airline_id"),
    ("flights_missing_origin_airport", "flights", "origin_airport_id", "airports", "airport_id"),
    ("flights_missing_destination_airport", "flights", "destination_airport_id", "airports", "airport_id"),
    ("bookings_missing_passenger", "bookings", "passenger_id", "passengers", "passenger_id"),
    ("bookings_missing_flight", "bookings", "flight_id", "flights", "flight_id"),
    ("payments_missing_booking", "payments", "booking_id", "bookings", "booking_id"),
)


def orphan_counts(tables: dict[str, DataFrame], child: str, checks, empty_as_null: bool = False) -> DataFrame:
    """One row: the orphans of every check of one child table, in one scan of it.

    Each (check, key) of a row is counted before the shuffle; the distinct keys
    meet the parents' keys in one anti join. A null key has no parent."""
    pairs = F.array(*[F.struct(F.lit(i).alias("_i"), F.col(fk).cast("bigint").alias("_k")) for i, (_, _, fk, _, _) in enumerate(checks)])
    per_key = (tables[child].select(F.explode(pairs).alias("p")).select("p._i", "p._k")
               .groupBy("_i", "_k").agg(F.count(F.lit(1)).alias("_c")))
    keys = _union([tables[p].select(F.lit(i).alias("_i"), F.col(pk).cast("bigint").alias("_k"))
                   for i, (_, _, _, p, pk) in enumerate(checks)]).distinct().withColumn("_has", F.lit(1))
    lost = F.when(F.col("_has").isNull(), F.col("_c"))
    if empty_as_null:   # SUM over an empty child is null
        lost = F.coalesce(lost, F.lit(0))
    sums = [F.sum(F.when(F.col("_i") == i, lost)) for i in range(len(checks))]
    joined = per_key.join(keys, ["_i", "_k"], "left")
    return joined.agg(*[(s if empty_as_null else F.coalesce(s, F.lit(0))).cast("bigint").alias(c[0]) for s, c in zip(sums, checks)])


def _orphan_row(tables, empty_as_null, checks=FK_ORPHAN_CHECKS):
    children = list(dict.fromkeys(c[1] for c in checks))
    parts = [orphan_counts(tables, t, [c for c in checks if c[1] == t], empty_as_null) for t in children]
    return reduce(with_scalar, parts)


def fk_orphans_scalar(tables: dict[str, DataFrame]) -> DataFrame:
    """Q-02: six orphan counts as scalar columns of one row (0 when empty)."""
    return _orphan_row(tables, empty_as_null=False)


def fk_orphans_cte(tables: dict[str, DataFrame]) -> DataFrame:
    """Q-03: the same counts via conditional sums (NULL for an empty child)."""
    return _orphan_row(tables, empty_as_null=True)


PK_CHECKS = (
    ("airports_pk", "airports", "airport_id"),
    ("airlines_pk", "airlines", "airline_id"),
    ("flights_pk", "flights", "flight_id"),
    ("passengers_pk", "passengers", "passenger_id"),
    ("bookings_pk", "bookings", "booking_id"),
    ("payments_pk", "payments", "payment_id"),
)

FK_ISSUE_CHECKS = (
    ("flight_airline_fk", "flights", "airline_id", "airlines", "airline_id"),
    ("flight_origin_airport_fk", "flights", "origin_airport_id", "airports", "airport_id"),
    ("flight_destination_airport_fk", "flights", "destination_airport_id", "airports", "airport_id"),
    ("booking_flight_fk", "bookings", "flight_id", "flights", "flight_id"),
    ("booking_passenger_fk", "bookings", "passenger_id", "passengers", "passenger_id"),
    ("payment_booking_fk", "payments", "booking_id", "bookings", "booking_id"),
)


def pk_fk_issue_list(tables: dict[str, DataFrame]) -> DataFrame:
    """Q-04: 6 primary-key and 6 foreign-key checks in long format."""
    return key_issues(tables, PK_CHECKS, FK_ISSUE_CHECKS)


def non_null_distinct(df: DataFrame, col: str, check_name: str) -> DataFrame:
    """``count(x)`` and ``count(distinct x)`` over non-null values."""
    return (df.filter(F.col(col).isNotNull())
              .agg(F.count(F.lit(1)).alias("non_null_count"),
                   F.countDistinct(col).alias("distinct_non_null"))
              .select(F.lit(check_name).alias("check_name"), "non_null_count", "distinct_non_null"))


def uniqueness_summary(airlines: DataFrame, airports: DataFrame, passengers: DataFrame) -> DataFrame:
    """Q-05: non-null vs distinct counts of the natural keys."""
    return _union([
        non_null_distinct(airlines, "iata_code", "airlines_iata"),
        non_null_distinct(airlines, "icao_code", "airlines_icao"),
        non_null_distinct(airports, "iata_code", "airports_iata"),
        non_null_distinct(airports, "icao_code", "airports_icao"),
        non_null_distinct(passengers, "email", "passengers_email"),
    ]).orderBy("check_name")


def loyalty_one_per_passenger(loyalty_accounts: DataFrame) -> DataFrame:
    """Q-06: rows vs distinct passengers in loyalty accounts."""
    return loyalty_accounts.agg(F.count(F.lit(1)).alias("loyalty_rows"),
                                F.countDistinct("passenger_id").alias("distinct_passengers")) \
        .select(F.lit("loyalty_per_passenger").alias("check_name"), "loyalty_rows",
                "distinct_passengers")


def duplicated_keys(df: DataFrame, col: str, skip_nulls: bool = True) -> DataFrame:
    """One-row ``count``: key values that occur more than once."""
    d = df.filter(F.col(col).isNotNull()) if skip_nulls else df
    return (d.groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
             .filter(F.col("_c") > 1).agg(F.count(F.lit(1)).alias("count")))


def duplicate_key_counts(airlines, airports, passengers, loyalty_accounts) -> DataFrame:
    """Q-07: duplicated natural keys (metric label as in the source report)."""
    return _union([
        duplicated_keys(airlines, "iata_code").select(F.lit("airlines_iata_duplicates").alias("metric"), "count"),
        duplicated_keys(airports, "iata_code").select(F.lit("airports_iata_duplicates").alias("metric"), "count"),
        duplicated_keys(passengers, "email").select(F.lit("passenger_email_duplicates").alias("metric"), "count"),
        duplicated_keys(loyalty_accounts, "passenger_id", skip_nulls=False)
            .select(F.lit("loyalty_multiper_passenger").alias("metric"), "count"),
    ])


def problem_counts(fk_wide: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Q-08: melt the one-row orphan report to (metric, count) and append the
    duplicate counts."""
    cols = fk_wide.columns
    long = fk_wide.select(*[F.col(c).cast("bigint").alias(c) for c in cols]).unpivot(
        [], cols, "metric", "count")
    return long.unionByName(duplicates.select("metric", F.col("count").cast("bigint").alias("count")))


def _nulls(col):
    return F.sum(F.when(F.col(col).isNull(), 1).otherwise(0)).cast("bigint")


NULL_PROFILE = (
    ("airports", "iata_code", "icao_code"),
    ("airlines", "iata_code", "icao_code"),
    ("passengers", "email", "first_name"),
    ("bookings", "passenger_id", "flight_id"),
    ("payments", "booking_id", "amount_usd"),
)


def null_profile(tables: dict[str, DataFrame], spec=NULL_PROFILE) -> DataFrame:
    """Q-09: total rows and two null counts per table."""
    return _union([
        tables[t].agg(F.count(F.lit(1)).alias("total_rows"), _nulls(c1).alias("metric_1_nulls"),
                      _nulls(c2).alias("metric_2_nulls"))
                 .select(F.lit(t).alias("table_name"), "total_rows", "metric_1_nulls", "metric_2_nulls")
        for t, c1, c2 in spec]).orderBy("table_name")


def flights_null_profile(flights: DataFrame) -> DataFrame:
    """Q-10: null counts of the flight key columns. A flights table without
    an aircraft column (before the aircraft backfill) counts all rows."""
    f = flights if "aircraft_id" in flights.columns else \
        flights.withColumn("aircraft_id", F.lit(None).cast("bigint"))
    return f.agg(F.count(F.lit(1)).alias("total_rows"),
                 _nulls("airline_id").alias("airline_id_nulls"),
                 _nulls("aircraft_id").alias("aircraft_id_nulls"),
                 _nulls("route_id").alias("route_id_nulls"),
                 _nulls("origin_airport_id").alias("origin_id_nulls"),
                 _nulls("destination_airport_id").alias("dest_id_nulls"))


def bts_coverage(flight_performance: DataFrame, approx: bool = False) -> DataFrame:
    """Q-11: span and distinct coverage of the BTS snapshot; ``approx=True``
    uses HyperLogLog sketches instead (one pass, about 2% error)."""
    columns = (("year", "years_covered"), ("month", "months_covered"),
               ("airline_iata", "airlines_in_bts"), ("airport_iata", "airports_in_bts"))
    base = [F.min("year").alias("min_year"), F.max("year").alias("max_year")]
    if approx:
        return flight_performance.agg(*base, *[F.approx_count_distinct(c).alias(n) for c, n in columns],
                                      F.count(F.lit(1)).alias("total_rows"))
    # a distinct aggregate of its own for each column: rows are not multiplied
    counts = [flight_performance.select(c).distinct().agg(F.count(c).alias(n)) for c, n in columns]
    wide = reduce(with_scalar, [flight_performance.agg(*base, F.count(F.lit(1)).alias("total_rows")), *counts])
    return wide.select("min_year", "max_year", *[n for _, n in columns], "total_rows")


BTS_TOTALS = (
    ("arrivals", "total_arrivals"),
    ("arrivals_delayed_15min", "total_arrivals_15min_delayed"),
    ("arr_cancelled", "total_arr_cancelled"),
    ("arr_diverted", "total_arr_diverted"),
    ("total_arrival_delay_min", "total_delay_minutes"),
    ("carrier_delay", "total_carrier_delay_min"),
    ("weather_delay", "total_weather_delay_min"),
    ("nas_delay", "total_nas_delay_min"),
    ("security_delay", "total_security_delay_min"),
    ("late_aircraft_delay", "total_late_aircraft_delay_min"),
)


def bts_delay_totals(flight_performance: DataFrame) -> DataFrame:
    """Q-12: ten column totals. Delay-cause columns a snapshot lacks are
    all-null, so their totals are NULL (as SUM over nulls)."""
    fp = flight_performance
    aggs = []
    for src, name in BTS_TOTALS:
        if src in fp.columns:
            s = F.sum(src)
            aggs.append((s.cast("bigint") if src in ("arrivals", "arrivals_delayed_15min",
                                                      "arr_cancelled", "arr_diverted")
                         else s.cast("double")).alias(name))
        else:
            aggs.append(F.lit(None).cast("double").alias(name))
    return fp.agg(*aggs)


def fare_distribution(bookings: DataFrame) -> DataFrame:
    """Q-13: count/min/max/avg price by fare class (null class kept)."""
    return (bookings.groupBy("fare_class")
            .agg(F.count(F.lit(1)).alias("bookings"),
                 to_double(F.min("base_price_usd")).alias("min_price"),
                 to_double(F.max("base_price_usd")).alias("max_price"),
                 (to_double(F.sum("base_price_usd")) / F.count("base_price_usd")).alias("avg_price"))
            .orderBy(F.col("fare_class").asc_nulls_last()))


def payment_stats(payments: DataFrame) -> DataFrame:
    """Q-14: payment count, min, max, average."""
    return payments.agg(F.count(F.lit(1)).alias("payment_rows"),
                        to_double(F.min("amount_usd")).alias("min_payment"),
                        to_double(F.max("amount_usd")).alias("max_payment"),
                        (to_double(F.sum("amount_usd")) / F.count("amount_usd")).alias("avg_payment"))


def payment_summary(payments: DataFrame) -> DataFrame:
    """Q-14 variant with the revenue total."""
    return payments.agg(F.count(F.lit(1)).alias("num_payments"),
                        to_double(F.sum("amount_usd")).alias("total_revenue_usd"),
                        (to_double(F.sum("amount_usd")) / F.count("amount_usd")).alias("avg_ticket_price_usd"),
                        to_double(F.min("amount_usd")).alias("min_ticket_price_usd"),
                        to_double(F.max("amount_usd")).alias("max_ticket_price_usd"))


def booking_payment_mismatch(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """Q-15: bookings without a payment and payments without a booking, in
    one full outer join pass (each side shuffled once)."""
    b = bookings.select(F.col("booking_id").alias("_bk"), F.lit(1).alias("_b"))
    p = payments.select(F.col("booking_id").alias("_pk"), F.lit(1).alias("_p"))
    j = b.join(p, b._bk == p._pk, "full_outer")
    counts = j.agg(F.sum(F.when(F.col("_p").isNull(), 1).otherwise(0)).cast("bigint").alias("b"),
                   F.sum(F.when(F.col("_b").isNull(), 1).otherwise(0)).cast("bigint").alias("p"))
    return counts.select(F.explode(F.array(
        F.struct(F.lit("bookings_without_payments").alias("metric"),
                 F.coalesce(F.col("b"), F.lit(0)).cast("bigint").alias("count_rows")),
        F.struct(F.lit("payments_without_bookings").alias("metric"),
                 F.coalesce(F.col("p"), F.lit(0)).cast("bigint").alias("count_rows")))).alias("m")) \
        .select("m.*")


def flights_with_bookings(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Q-16: flights having at least one booking (semi join, no fan-out and
    no distinct) next to the total flight count."""
    booked = (flights.select("flight_id").join(bookings.select("flight_id"), "flight_id", "left_semi")
                     .agg(F.countDistinct("flight_id").alias("flights_with_bookings")))
    total = flights.agg(F.count(F.lit(1)).alias("total_flights"))
    return with_scalar(booked, total)


def bookings_per_passenger(bookings: DataFrame) -> DataFrame:
    """Q-17: distribution of bookings per passenger. ``total_bookings`` keeps
    the source report's meaning (it counts grouped passenger rows);
    ``booking_rows`` is the actual number of bookings."""
    per = bookings.groupBy("passenger_id").agg(F.count(F.lit(1)).alias("bookings_per_pax"))
    stats = per.agg(F.count(F.lit(1)).alias("total_bookings"),
                    F.count("passenger_id").alias("distinct_passengers"),
                    F.min("bookings_per_pax").alias("min_bookings_per_passenger"),
                    F.max("bookings_per_pax").alias("max_bookings_per_passenger"),
                    F.sum("bookings_per_pax").alias("booking_rows"))
    med = quantiles_of(value_counts(per, "bookings_per_pax"), [0.5], ["median_bookings_per_passenger"])
    return with_scalar(stats, med).select(
        "total_bookings", "distinct_passengers", "min_bookings_per_passenger",
        "median_bookings_per_passenger", "max_bookings_per_passenger", "booking_rows")
