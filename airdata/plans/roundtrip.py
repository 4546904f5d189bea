"""Catalogue entries for files and tables: driver columns are written as the raw
files of the source, or as committed tables, and read back (S-02, S-03, S-05,
S-06, S-08, W-01, W-02, W-04)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airdata.plans.registry import query
from airdata.session import checkpoint_dir
from airdata.sources import files as S
from airdata.sources import sinks as W
from airdata.sources.tables import written


def _folder(fx, name: str) -> str:
    """A fresh folder beside the checkpoints, which all executors share."""
    return W.join(checkpoint_dir(fx.spark), f"{name}-{uuid.uuid4().hex}")


def _written(df: DataFrame, path: str, header: bool) -> str:
    df.write.option("header", header).option("escape", '"').option("emptyValue", "").csv(path)
    return path


@query("load_airports_file", "S-02/K-02/C-18", r"""
WITH raw AS (
  SELECT s_suppkey AS k, CASE WHEN s_suppkey % 10 = 3 THEN NULL ELSE lpad((s_suppkey % 40)::VARCHAR, 3, '0') END AS iata_code,
         CASE WHEN s_suppkey % 20 = 3 THEN NULL ELSE 'K' || lpad((s_suppkey % 1000)::VARCHAR, 3, '0') END AS icao_code FROM supplier)
SELECT 'Field "' || k || '", North' AS name, iata_code, icao_code, CASE WHEN k % 11 = 0 THEN NULL ELSE k % 90 + 0.5 END::DOUBLE AS latitude,
       CASE WHEN k % 4 = 0 THEN (k % 24)::VARCHAR ELSE 'Zone/' || k % 5 END AS timezone
FROM raw WHERE iata_code IS NOT NULL OR icao_code IS NOT NULL
QUALIFY iata_code IS NULL OR row_number() OVER (PARTITION BY iata_code ORDER BY k) = 1""")
def _load_airports_file(fx):
    k = F.col("s_suppkey")
    code = F.lpad((k % 40).cast("string"), 3, "0")
    raw = fx.table("supplier", ["s_suppkey"]).orderBy("s_suppkey").select(
        k.cast("string").alias("airport_src_id"), F.concat(F.lit('Field "'), k.cast("string"), F.lit('", North')).alias("name"),
        F.lit(" City ").alias("city"), F.lit("Land").alias("country"), F.when(k % 10 == 3, "\\N").otherwise(F.concat(F.lit(" "), code)).alias("iata"),
        F.when(k % 20 == 3, "\\N").otherwise(F.concat(F.lit("k"), F.lpad((k % 1000).cast("string"), 3, "0"))).alias("icao"),
        F.when(k % 11 == 0, "north").otherwise((k % 90 + 0.5).cast("string")).alias("latitude"), F.lit("1.5").alias("longitude"), F.lit("0").alias("altitude"),
        (k % 24).cast("string").alias("tz_offset"), F.lit("U").alias("dst"),
        F.when(k % 4 == 0, "\\N").otherwise(F.concat(F.lit("Zone/"), (k % 5).cast("string"))).alias("tz_name"), F.lit("airport").alias("type"), F.lit("x").alias("source"))
    path = _written(raw, _folder(fx, "airports"), False)
    done = S.load_airports_file(fx.spark, path, fx.spark.createDataFrame([], "iata_code string"))
    return done.insert.select("name", "iata_code", "icao_code", F.col("latitude").cast("double").alias("latitude"), "timezone")


@query("load_airlines_file", "S-03/K-04", """
SELECT 'Line ' || c_custkey AS name, lpad((c_custkey % 300)::VARCHAR, 3, '0') AS iata_code FROM customer WHERE c_custkey % 9 <> 0
QUALIFY row_number() OVER (PARTITION BY c_custkey % 300 ORDER BY c_custkey) = 1""")
def _load_airlines_file(fx):
    k = F.col("c_custkey")
    raw = fx.table("customer", ["c_custkey"]).orderBy("c_custkey").select(
        k.cast("string"), F.when(k % 9 != 0, F.concat(F.lit("Line "), k.cast("string"))), F.lit("\\N"), F.lpad((k % 300).cast("string"), 3, "0"),
        F.lit("\\N"), F.lit("C"), F.lit("Land"), F.lit("Y")).toDF(*S.AIRLINE_FIELDS)
    path = _written(raw, _folder(fx, "airlines"), False)
    done = S.load_airlines_file(fx.spark, path, fx.spark.createDataFrame([], "iata_code string, icao_code string"))
    return done.insert.select("name", "iata_code")


_MONTHS = """
WITH m AS (
  SELECT year(l_shipdate)::INT AS y, month(l_shipdate)::INT AS m, l_suppkey AS s, sum(l_linenumber)::INT AS n FROM lineitem GROUP BY ALL)"""


def _months(fx):
    """A row a month and supplier, as the texts of canonical monthly files."""
    li = fx.table("lineitem", ["l_suppkey", "l_linenumber", "l_shipdate"])
    m = li.groupBy(F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), F.col("l_suppkey").alias("s")).agg(F.sum("l_linenumber").alias("n"))
    value = {"year": F.col("y"), "month": F.col("m"), "airline_iata": F.concat(F.lit(" n"), (F.col("s") % 25).cast("string")),
             "airport_iata": F.concat(F.lit("s"), F.col("s").cast("string")), "arrivals": F.col("n")}
    return m.select("s", *[value.get(c, F.lit(1)).cast("string").alias(c) for c in S.BTS_CANONICAL])


@query("load_mixed_folder", "S-05/C-10/K-03/K-20", _MONTHS + """
SELECT y || '-' || lpad(m::VARCHAR, 2, '0') || '-N' || s % 25 || '-S' || s AS snapshot_id, n AS arrivals,
       CASE WHEN s % 6 = 5 THEN 'unknown layout' WHEN s % 7 = 0 THEN 'unknown airport' WHEN m = 12 THEN 'there already' ELSE 'loaded' END AS outcome
FROM m WHERE s % 6 <> 5
UNION ALL SELECT NULL, NULL, 'unknown layout' FROM m WHERE s % 6 = 5""")
def _load_mixed_folder(fx):
    months, root, back = written(_months(fx), "months-shaped"), _folder(fx, "months"), {new: old for old, new in S.BTS_OLD_NAMES.items()}
    old = [F.col(c).alias(back.get(c, c)) for c in S.BTS_CANONICAL]
    layouts = {"canonical": [F.col(c) for c in S.BTS_CANONICAL], "old": old, "reordered": list(reversed(old)), "wide": [F.lit("x").alias("extra"), *old],
               "shouting": [F.col(c).alias(f" {c.upper()}") for c in S.BTS_CANONICAL], "strange": [F.col(c).alias(f"q_{c}") for c in S.BTS_CANONICAL]}
    for i, (name, columns) in enumerate(layouts.items()):
        _written(months.filter(F.col("s") % 6 == i).select(*columns), W.join(root, name), True)
    key = S.normalise_bts(months.filter("month = '12'").drop("s")).select("snapshot_id")
    airports = fx.table("supplier", ["s_suppkey"]).filter("s_suppkey % 7 <> 0").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("iata_code"))
    done = S.load_monthly(fx.spark, root, key, airports)
    rows = done.insert.select("snapshot_id", "arrivals", F.lit("loaded").alias("outcome")).unionByName(
        done.duplicates.select("snapshot_id", "arrivals", F.lit("there already").alias("outcome")))
    rejected = F.from_csv("line", S.MONTHLY_DDL)
    known = F.col("reason") != "unknown layout"
    return rows.unionByName(done.rejects.select(F.when(known, rejected["snapshot_id"]).alias("snapshot_id"), F.when(known, rejected["arrivals"]).alias("arrivals"), F.col("reason").alias("outcome")))


@query("load_flight_files", "S-06/K-03/K-19", """
SELECT o_custkey % 25 AS airline_id, o_orderkey::VARCHAR AS flight_number, o_orderdate::DATE AS flight_date, 1 AS origin_airport_id, 2 AS destination_airport_id
FROM orders WHERE o_custkey % 25 < 20 AND o_orderkey % 4 <> 0""")
def _load_flight_files(fx):
    o, root = fx.table("orders", ["o_orderkey", "o_custkey", "o_orderdate"]), _folder(fx, "flight-files")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    code = F.concat(F.lit("C"), (F.col("o_custkey") % 25).cast("string"))
    common = [k.cast("string").alias("MKT_CARRIER_FL_NUM"), F.date_format(day, "yyyy-MM-dd").alias("FL_DATE"), F.lit("AAA").alias("ORIGIN"), F.lit("BBB").alias("DEST")]
    _written(o.filter(k % 2 == 0).select(code.alias("MKT_UNIQUE_CARRIER"), *common), W.join(root, "marketing"), True)
    _written(o.filter(k % 2 == 1).select(*reversed(common), code.alias("OP_UNIQUE_CARRIER")), W.join(root, "operating"), True)
    rows, _ = S.read_flight_files(fx.spark, root)
    airlines = fx.spark.range(20).select(F.col("id").alias("airline_id"), F.concat(F.lit("C"), F.col("id").cast("string")).alias("iata_code"))
    airports = fx.spark.createDataFrame([(1, "AAA"), (2, "BBB")], "airport_id long, iata_code string")
    there = o.filter(k % 4 == 0).select((F.col("o_custkey") % 25).alias("airline_id"), k.cast("string").alias("flight_number"), day.cast("date").alias("flight_date"))
    ins, _ = S.load_bts_flights(there, rows, airlines, airports)
    return ins.select("airline_id", "flight_number", "flight_date", F.col("origin_airport_id").cast("int").alias("origin_airport_id"), F.col("destination_airport_id").cast("int").alias("destination_airport_id"))


@query("profile_raw_file", "S-08", """
SELECT count(*) AS n_rows, 's_suppkey,s_name,s_nationkey' AS columns FROM supplier""")
def _profile_raw_file(fx):
    path = _written(fx.table("supplier", ["s_suppkey", "s_name", "s_nationkey"]), _folder(fx, "profile"), True)
    raw = S.read_csv_header(fx.spark, path)
    _, columns, _ = S.profile_raw(raw)
    return raw.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("columns", F.lit(",".join(columns)))


@query("write_csv_table", "W-01", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _write_csv_table(fx):
    of = fx.table("customer", ["c_custkey", "c_name", "c_nationkey"])
    path = _folder(fx, "csv")
    W.write_csv(of, path)
    return S.read_csv_header(fx.spark, path).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in of.schema])


@query("append_in_batches", "W-02", "SELECT o_orderkey, o_custkey, year(o_orderdate)::INT AS year FROM orders")
def _append_in_batches(fx):
    o = fx.table("orders", ["o_orderkey", "o_custkey", "o_orderdate"]).select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    root = _folder(fx, "appended")
    for key in ("even", "odd", "even"):   # a batch that is loaded again
        W.append_table(o.filter(F.col("o_orderkey") % 2 == int(key == "odd")), root, key, ["year"])
    return W.read_table(fx.spark, root)


@query("rewrite_cleaned_table", "W-04/C-07", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 25 THEN NULL ELSE l_quantity::DOUBLE END AS quantity FROM lineitem""")
def _rewrite_cleaned_table(fx):
    li = fx.table("lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]).select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("quantity"))
    root = _folder(fx, "rewritten")
    W.append_table(li, root, "load")
    old = W.read_table(fx.spark, root)
    for _ in range(2):   # the second run of the same step changes nothing
        W.rewrite_table(old.withColumn("quantity", F.when(F.col("quantity") <= 25, F.col("quantity"))), root, "clean")
    return W.read_table(fx.spark, root)
