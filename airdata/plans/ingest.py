"""Catalogue entries for the normalisation of raw rows (S-04 .. S-06, C-09 ..
C-11, C-13, C-14, C-17, C-19, V-10) on texts made from driver columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from airdata.functions import clean as C
from airdata.operators.constraints import require_non_empty
from airdata.plans.registry import query
from airdata.sources import files as S


def _raw_months(fx):
    """Lines as monthly rows of text: padded headers and codes, bad numbers."""
    li = fx.table("lineitem", ["l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"])
    line, text = F.col("l_linenumber") % 4, F.col("l_quantity").cast("string")
    spotty = F.when(line == 0, "NaN").when(line == 1, "").when(line == 2, text).otherwise("n/a")
    code = F.concat(F.lit(" n"), (F.col("l_suppkey") % 25).cast("string"))
    return li.select(
        F.year("l_shipdate").cast("string").alias(" Year"), F.month("l_shipdate").cast("string").alias("MONTH "),
        code.alias("Carrier"), F.lit("x").alias("carrier_name"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string"), F.lit("\t")).alias("airport"),
        F.lit("y").alias("airport_name"), spotty.alias("arr_flights"), text.alias("arr_del15"), spotty.alias("arr_cancelled"),
        F.lit(None).cast("string").alias("arr_diverted"), text.alias("arr_delay"), spotty.alias("carrier_delay"),
        *[text.alias(c) for c in ("weather_delay", "nas_delay", "security_delay", "late_aircraft_delay")])


@query("normalise_bts_rows", "S-05/C-09/C-10/C-11/C-12/V-10", """
WITH r AS (
  SELECT year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, 'N' || (l_suppkey % 25) AS airline_iata,
         'S' || l_suppkey AS airport_iata, l_quantity AS q, CASE WHEN l_linenumber % 4 = 2 THEN l_quantity ELSE 0 END AS z
  FROM lineitem)
SELECT year, month, airline_iata, airport_iata, round(z)::INT AS arrivals, round(q)::INT AS arrivals_delayed_15min,
       round(z)::INT AS arr_cancelled, 0 AS arr_diverted, q AS total_arrival_delay_min, z::DOUBLE AS carrier_delay,
       q AS weather_delay, q AS nas_delay, q AS security_delay, q AS late_aircraft_delay,
       year || '-' || lpad(month::VARCHAR, 2, '0') || '-' || airline_iata || '-' || airport_iata AS snapshot_id
FROM r""")
def _normalise_bts_rows(fx):
    return S.normalise_bts(require_non_empty(_raw_months(fx), "lineitem"))


@query("clean_bts_aggregate", "S-04/C-09/C-11", """
SELECT year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS month, ' n' || (l_suppkey % 25) AS airline_iata,
       CASE WHEN l_linenumber % 4 = 2 THEN l_quantity ELSE 0 END::DOUBLE AS arrivals, l_quantity AS total_arrival_delay_min,
       year(l_shipdate) || '_' || lpad(month(l_shipdate)::VARCHAR, 2, '0') || '_ n' || (l_suppkey % 25) || '_s' || l_suppkey
         || chr(9) AS snapshot_id
FROM lineitem""")
def _clean_bts_aggregate(fx):
    return S.clean_bts_aggregate(_raw_months(fx)).select(
        "year", "month", "airline_iata", "arrivals", "total_arrival_delay_min", "snapshot_id")


@query("normalise_flight_rows", "S-06/C-13/C-14", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'M' || (o_orderkey % 7) ELSE 'O' || (o_orderkey % 7) END AS airline_code,
       o_orderkey::VARCHAR AS flight_number, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE END AS flight_date,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate::DATE + INTERVAL 6 HOUR END AS sched_dep_utc,
       CASE o_orderkey % 4 WHEN 0 THEN 'Cancelled' WHEN 1 THEN 'Arrived' WHEN 2 THEN 'Scheduled' ELSE 'Cancelled' END AS status
FROM orders""")
def _normalise_flight_rows(fx):
    o = fx.table("orders", ["o_orderkey", "o_orderdate"])
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    seventh = (k % 7).cast("string")
    raw = o.select(
        F.when(k % 2 == 0, F.concat(F.lit(" M"), seventh)).otherwise("  ").alias("MKT_UNIQUE_CARRIER"),
        F.concat(F.lit("O"), seventh).alias("OP_UNIQUE_CARRIER"), F.concat(k.cast("string"), F.lit(" ")).alias("MKT_CARRIER_FL_NUM"),
        F.when(k % 3 == 0, F.concat(F.date_format(day, "M/d/yyyy"), F.lit(" 12:00:00 AM")))
         .when(k % 3 == 1, F.date_format(day, "yyyy-MM-dd")).otherwise("soon").alias("FL_DATE"),
        F.when(k % 5 != 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 06:00:00"))).alias("CRS_DEP_TIME_UTC"),
        F.when(k % 4 == 0, "1").when(k % 4 == 1, "0").when(k % 4 == 2, "").otherwise("1.0").alias("CANCELLED"))
    return S.normalise_flight_rows(raw).select("airline_code", "flight_number", "flight_date", "sched_dep_utc", "status")


@query("age_bands_and_zones", "C-17/C-19", """
SELECT c_custkey AS passenger_id,
       CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 60 < 8 THEN '18-25' WHEN c_custkey % 60 < 18 THEN '26-35'
            WHEN c_custkey % 60 < 28 THEN '36-45' WHEN c_custkey % 60 < 43 THEN '46-60' ELSE '60+' END AS age_group,
       CASE WHEN c_custkey % 3 = 2 THEN 'Zone/' || c_custkey ELSE (c_custkey % 24)::VARCHAR END AS timezone
FROM customer""")
def _age_bands_and_zones(fx):
    c = fx.table("customer", ["c_custkey"])
    k = F.col("c_custkey")
    raw = c.select("c_custkey", F.when(k % 11 != 0, 18 + k % 60).alias("age"),
                   F.when(k % 3 == 0, F.lit("\\N")).when(k % 3 == 1, "  ").otherwise(F.concat(F.lit(" Zone/"), k.cast("string"))).alias("tz"),
                   (k % 24).cast("string").alias("shift"))
    return raw.select(F.col("c_custkey").alias("passenger_id"), C.age_bucket("age").alias("age_group"),
                      C.first_non_blank("tz", "shift").alias("timezone"))
