"""Catalogue entries for cleaning expressions (C-01 .. C-22) on the fixtures.

The dirty airport codes (``''``, ``' '``, ``'NA'``, ``'\\N'``, ``'  '``,
``' na '``, padded codes) exercise the one-pass vs fixpoint behaviour.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from airdata.functions import clean as C
from airdata.plans.registry import query
from airdata.plans.views_sql import with_views as W

# DuckDB has no INITCAP: words are runs of letters/digits.
_INITCAP = ("array_to_string(list_transform(regexp_extract_all(lower({x}), "
            "'[\\pL\\pN]+|[^\\pL\\pN]+'), lambda w: upper(w[1]) || w[2:]), '')")


def _sent(x):
    return f"CASE WHEN {x} IN ('', ' ', 'NA', '\\N') THEN NULL ELSE {x} END"


def _strip_null(x):
    s = f"nullif(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '')"
    return f"nullif({s}, '\\N')"


@query("clean_airport_codes", "C-01/C-02/C-03/C-05/C-15/C-16", W(f"""
SELECT airport_id,
       {_strip_null('iata_code')} AS iata_stripped,
       upper(trim({_sent('iata_code')}, ' ')) AS iata_one_pass,
       upper(trim({_sent(f"upper(trim({_sent('iata_code')}, ' '))")}, ' ')) AS iata_fixpoint,
       upper(substr({_strip_null('iata_code')}, 1, 3)) AS iata_truncated,
       {_INITCAP.format(x="trim(name, ' ')")} AS name_clean,
       try_cast(try_cast(cast(latitude AS varchar) AS double) AS decimal(8,5)) AS latitude_parsed
FROM airports_dirty""", "airports_dirty"))
def _clean_airport_codes(fx):
    d = fx.airports_dirty
    return d.select(
        "airport_id",
        C.clean_str("iata_code").alias("iata_stripped"),
        C.clean_code("iata_code").alias("iata_one_pass"),
        C.clean_code("iata_code", fixpoint=True).alias("iata_fixpoint"),
        C.truncate_code(C.clean_str("iata_code"), 3).alias("iata_truncated"),
        C.initcap_trim("name").alias("name_clean"),
        C.parse_coordinate(F.col("latitude").cast("string")).alias("latitude_parsed"))


@query("drop_unusable_airports", "C-18", W(f"""
SELECT airport_id, {_strip_null('iata_code')} AS iata_code
FROM airports_dirty WHERE {_strip_null('iata_code')} IS NOT NULL""", "airports_dirty"))
def _drop_unusable_airports(fx):
    d = fx.airports_dirty.select("airport_id", C.clean_str("iata_code").alias("iata_code"))
    return d.filter(F.col("iata_code").isNotNull())


@query("clean_passengers", "C-04/C-05/C-06", W(f"""
SELECT passenger_id, {_INITCAP.format(x="trim(first_name, ' ')")} AS first_name,
       lower(trim(email, ' ')) AS email,
       nullif(trim(first_name, ' '), '') AS first_name_trimmed
FROM passengers""", "passengers"))
def _clean_passengers(fx):
    p = fx.passengers
    return p.select("passenger_id", C.initcap_trim("first_name").alias("first_name"),
                    C.lower_trim("email").alias("email"),
                    C.trim_blank_null("first_name").alias("first_name_trimmed"))


@query("negative_to_null", "C-07", W("""
SELECT payment_id, CASE WHEN amount_usd >= 0 THEN cast(amount_usd AS double) END AS amount_usd,
       amount_usd < 0 AS quarantined
FROM payments_orphan""", "payments_orphan"))
def _negative_to_null(fx):
    p = fx.payments_orphan
    return p.select("payment_id", C.negative_to_null("amount_usd").cast("double").alias("amount_usd"),
                    (F.col("amount_usd") < 0).alias("quarantined"))


@query("clamp_and_default", "C-08", W("""
SELECT b.booking_id,
       cast(least(greatest(b.base_price_usd, 80), 900) AS double) AS price_clamped,
       CASE WHEN b.base_price_usd > 0 THEN cast(b.base_price_usd AS double) END AS price_positive,
       greatest(cast(floor(c.c_acctbal) AS bigint), 0) AS balance_floor_zero,
       coalesce(m.miles_delta, 0) AS miles_delta
FROM bookings b JOIN customer c ON c.c_custkey = b.passenger_id
LEFT JOIN miles_transactions m ON m.miles_txn_id = b.flight_id""", "bookings", "miles_transactions"))
def _clamp_and_default(fx):
    b = fx.bookings.select("booking_id", "passenger_id", "flight_id", "base_price_usd")
    c = fx.table("customer", ["c_custkey", "c_acctbal"])
    m = fx.miles_transactions.select(F.col("miles_txn_id").alias("flight_id"), "miles_delta")
    j = (b.join(c, b.passenger_id == c.c_custkey).join(m, "flight_id", "left"))
    return j.select("booking_id",
                    C.clamp("base_price_usd", 80, 900).cast("double").alias("price_clamped"),
                    C.non_positive_to_null("base_price_usd").cast("double").alias("price_positive"),
                    C.clamp_min(F.floor("c_acctbal"), 0).cast("bigint").alias("balance_floor_zero"),
                    C.null_to_zero("miles_delta").alias("miles_delta"))


@query("snapshot_ids", "C-12", W("""
SELECT concat_ws('-', CASE WHEN length(cast(year AS varchar)) >= 4 THEN cast(year AS varchar)
                           ELSE lpad(cast(year AS varchar), 4, '0') END,
                      CASE WHEN length(cast(month AS varchar)) >= 2 THEN cast(month AS varchar)
                           ELSE lpad(cast(month AS varchar), 2, '0') END,
                 airline_iata, airport_iata) AS snapshot_id,
       concat_ws('_', cast(year AS varchar), lpad(cast(month AS varchar), 2, '0'),
                 airline_iata, airport_iata) AS snapshot_key_underscore,
       arrivals
FROM flight_performance""", "flight_performance"))
def _snapshot_ids(fx):
    fp = fx.flight_performance
    return fp.select(C.snapshot_id("year", "month", "airline_iata", "airport_iata").alias("snapshot_id"),
                     C.snapshot_id("year", "month", "airline_iata", "airport_iata", sep="_")
                     .alias("snapshot_key_underscore"),
                     "arrivals")


@query("flight_numbers", "C-20", W("""
SELECT f.flight_id, printf('%s%04d', a.iata_code, cast(f.flight_id % 10000 AS integer)) AS flight_number
FROM flights f JOIN airlines a ON a.airline_id = f.airline_id""", "flights", "airlines"))
def _flight_numbers(fx):
    f = fx.flights_base.select("flight_id", "airline_id")
    a = fx.airlines.select("airline_id", "iata_code")
    return f.join(a, "airline_id").select(
        "flight_id", C.flight_number(F.col("iata_code"), F.col("flight_id") % 10000).alias("flight_number"))


def scheduled_times(flights):
    """Schedule for the fixture flights (which carry only a date): departure
    at hour 5 + id % 18 and minute 15 * (id % 4), block 60 + id % 301 min."""
    fid = F.col("flight_id")
    dep = (F.col("flight_date").cast("timestamp_ntz")
           + F.make_dt_interval(F.lit(0), (5 + fid % 18).cast("int"), ((fid % 4) * 15).cast("int")))
    arr = dep + F.make_dt_interval(F.lit(0), F.lit(0), (60 + fid % 301).cast("int"))
    return flights.withColumn("scheduled_departure_utc", dep).withColumn("scheduled_arrival_utc", arr)


@query("derive_actual_times", "C-21", W("""
WITH s AS (
  SELECT flight_id, status, delay_minutes,
         cast(flight_date AS timestamp) + to_hours(5 + flight_id % 18) + to_minutes((flight_id % 4) * 15)
           AS scheduled_departure_utc
  FROM flights),
t AS (SELECT *, scheduled_departure_utc + to_minutes(60 + flight_id % 301) AS scheduled_arrival_utc FROM s)
SELECT flight_id, status, scheduled_departure_utc, scheduled_arrival_utc,
       CASE WHEN lower(status) LIKE 'cancel%' OR lower(status) LIKE 'sched%' THEN NULL
            ELSE scheduled_departure_utc + to_minutes(coalesce(delay_minutes, 0)) END AS actual_departure_utc,
       CASE WHEN lower(status) LIKE 'cancel%' OR lower(status) LIKE 'sched%' THEN NULL
            ELSE scheduled_arrival_utc + to_minutes(coalesce(delay_minutes, 0)) END AS actual_arrival_utc
FROM t""", "flights"))
def _derive_actual_times(fx):
    f = scheduled_times(fx.flights_base.select("flight_id", "flight_date", "status", "delay_minutes"))
    dep, arr = C.actual_times("status", "scheduled_departure_utc", "scheduled_arrival_utc",
                              "delay_minutes")
    return f.select("flight_id", "status", "scheduled_departure_utc", "scheduled_arrival_utc", dep, arr)


@query("signed_miles", "C-22", W("""
SELECT miles_txn_id, txn_type,
       CASE WHEN lower(txn_type) LIKE '%redeem%' OR lower(txn_type) LIKE '%spend%'
                 OR lower(txn_type) LIKE '%debit%' THEN -abs(miles_delta) ELSE abs(miles_delta) END
         AS miles_signed
FROM miles_transactions""", "miles_transactions"))
def _signed_miles(fx):
    m = fx.miles_transactions
    return m.select("miles_txn_id", "txn_type",
                    C.signed_miles("txn_type", "miles_delta").alias("miles_signed"))
