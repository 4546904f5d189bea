"""Airline tables derived from the driver's TPC-H-shaped tables.

The mapping is fixed by FIXTURES.md §5-§6: every view below is DataFrame code
computing exactly what the SQL views there compute (the same SQL text is the
DuckDB oracle side, see ``airdata.plans.views_sql``). The derived tables grow
with the driver tables, so every query's work grows with the data.

Scale notes
-----------
- ``flights``, ``routes``, ``bookings`` and ``clv``, and the flights that the first
  three are derived from, are written once, as loaded tables would be, and read
  by column: what they stand for is joined and grouped once, whatever the number
  of readers. ``flights_base`` is a view, pruned by its reader.
- ``routes.route_id`` and ``bookings.booking_id`` are ``row_number()`` over a
  total order; they are assigned with the distributed K-01 operator (range
  partitioning + per-partition offsets), never with a one-task window.
- Joins to ``customer``/``flights_base`` are left-semi joins: only the key is
  shuffled, no columns are carried.
- Nothing here forces a broadcast: the dimension sides are derived from
  ``supplier``/``nation`` whose sizes grow with the scale factor, so Spark's
  size checks (static threshold + AQE's measured sizes) choose.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airdata.operators.keys import number_rows
from airdata.operators.reports import get_clv
from airdata.sources.tables import scan_table, written


def _pad(col, width):
    """Zero-padded to ``width``; longer numbers stay whole, so codes never repeat."""
    text = col.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


class Fixtures:
    """Lazily built airline views for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str, columns=None) -> DataFrame:
        return scan_table(self.spark, self.sf_dir, name, columns)

    # ------------------------------------------------------------ dimensions
    @cached_property
    def airlines(self) -> DataFrame:
        n = self.table("nation", ["n_nationkey", "n_name", "n_regionkey"])
        r = self.table("region", ["r_regionkey", "r_name"])
        return (n.join(r, n.n_regionkey == r.r_regionkey)
                 .select(F.col("n_nationkey").cast("bigint").alias("airline_id"),
                         F.col("n_name").alias("name"),
                         F.concat(F.lit("N"), _pad(F.col("n_nationkey"), 2)).alias("iata_code"),
                         F.concat(F.lit("A"), _pad(F.col("n_nationkey"), 2)).alias("icao_code"),
                         F.col("r_name").alias("country")))

    @cached_property
    def airports(self) -> DataFrame:
        s = self.table("supplier", ["s_suppkey", "s_name", "s_nationkey"])
        k = F.col("s_suppkey")
        hole = (k % 17) == 16
        return s.select(
            k.alias("airport_id"),
            F.concat(F.lit("S"), _pad(k, 4)).alias("iata_code"),
            F.concat(F.lit("K"), _pad(k, 4)).alias("icao_code"),
            F.col("s_name").alias("name"),
            F.concat(F.lit("Country "), F.col("s_nationkey").cast("string")).alias("country"),
            F.when(~hole, ((k * 37) % 181 - 90).cast("decimal(8,5)")).alias("latitude"),
            F.when(~hole, ((k * 73) % 361 - 180).cast("decimal(8,5)")).alias("longitude"))

    # ----------------------------------------------------------------- facts
    @cached_property
    def od(self) -> DataFrame:
        li = self.table("lineitem", ["l_orderkey", "l_suppkey", "l_partkey"])
        return (li.groupBy("l_orderkey")
                  .agg(F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi"),
                       F.min("l_partkey").alias("part"))
                  .filter(F.col("lo") != F.col("hi")))

    @cached_property
    def flights_base(self) -> DataFrame:
        o = self.table("orders", ["o_orderkey", "o_orderdate", "o_orderpriority"])
        k = F.col("o_orderkey")
        even = (k % 2) == 0
        prio = F.col("o_orderpriority")
        delay = (F.when((k % 50) == 49, F.lit(None))
                  .when(prio == "4-NOT SPECIFIED", 60 + k % 241)
                  .when(prio == "1-URGENT", F.lit(0))
                  .otherwise((k * 7) % 181)).cast("int")
        status = (F.when(prio == "1-URGENT", "Scheduled")
                   .when(prio == "2-HIGH", "Departed")
                   .when(prio == "3-MEDIUM", "Arrived")
                   .when(prio == "4-NOT SPECIFIED", "Cancelled")
                   .otherwise("Diverted"))
        return (o.join(self.od, o.o_orderkey == self.od.l_orderkey)
                 .select(k.alias("flight_id"),
                         (k % 25).alias("airline_id"),
                         F.when(even, F.col("lo")).otherwise(F.col("hi")).alias("origin_airport_id"),
                         F.when(even, F.col("hi")).otherwise(F.col("lo")).alias("destination_airport_id"),
                         F.concat(F.lit("N"), _pad(k % 25, 2), _pad(k % 9999, 4)).alias("flight_number"),
                         F.col("o_orderdate").cast("date").alias("flight_date"),
                         F.when((k % 9) != 4, F.col("part")).alias("aircraft_id"),
                         delay.alias("delay_minutes"),
                         status.alias("status")))

    @cached_property
    def flights_loaded(self) -> DataFrame:
        """``flights_base``, for the tables that are derived from it."""
        return written(self.flights_base, "flights_base")

    @cached_property
    def routes(self) -> DataFrame:
        keys = ["airline_id", "origin_airport_id", "destination_airport_id"]
        distinct = written(self.flights_loaded.select(*keys).distinct(), "routes_distinct")
        return number_rows(distinct, keys, "route_id", "routes")

    @cached_property
    def flights(self) -> DataFrame:
        f = self.flights_loaded.alias("f")
        r = self.routes.alias("r")
        cond = ((F.col("r.airline_id") == F.col("f.airline_id"))
                & (F.col("r.origin_airport_id") == F.col("f.origin_airport_id"))
                & (F.col("r.destination_airport_id") == F.col("f.destination_airport_id"))
                & ((F.col("f.flight_id") % 40) != 0))
        return written(f.join(r, cond, "left").select(
            "f.flight_id", "f.airline_id", "f.aircraft_id", "r.route_id", "f.origin_airport_id",
            "f.destination_airport_id", "f.flight_number", "f.flight_date",
            "f.delay_minutes", "f.status"), "flights")

    @cached_property
    def passengers(self) -> DataFrame:
        c = self.table("customer", ["c_custkey", "c_name"])
        return c.select(F.col("c_custkey").alias("passenger_id"),
                        F.col("c_name").alias("first_name"),
                        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"))

    @cached_property
    def bookings(self) -> DataFrame:
        li = self.table("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                     "l_extendedprice", "l_shipdate"])
        cust = self.table("customer", ["c_custkey"])
        fb = self.flights_loaded.select("flight_id")
        grouped = (li.join(cust, li.l_partkey == cust.c_custkey, "left_semi")
                     .join(fb, li.l_orderkey == fb.flight_id, "left_semi")
                     .groupBy("l_partkey", "l_orderkey")
                     .agg(F.min("l_shipdate").alias("booking_date"),
                          F.max("l_linenumber").alias("_maxline"),
                          F.min("l_extendedprice").alias("_minprice"),
                          F.min("l_suppkey").alias("_minsupp")))
        fare = F.col("_maxline") % 5
        chan = F.col("_minsupp") % 4
        shaped = grouped.select(
            F.col("l_partkey").alias("passenger_id"),
            F.col("l_orderkey").alias("flight_id"),
            "booking_date",
            F.when(fare == 0, "Basic").when(fare == 1, "Standard").when(fare == 2, "Flexible")
             .when(fare == 3, "Business").otherwise("First").alias("fare_class"),
            F.col("_minprice").cast("decimal(10,2)").alias("base_price_usd"),
            F.when(chan == 0, "Web").when(chan == 1, "Mobile").when(chan == 2, "Call Center")
             .otherwise("Travel Agent").alias("booking_channel"))
        return number_rows(written(shaped, "bookings_shaped"), ["passenger_id", "flight_id"], "booking_id", "bookings")

    @cached_property
    def payments(self) -> DataFrame:
        b = F.col("booking_id")
        m10 = b % 10
        m20 = b % 20
        return (self.bookings.filter((b % 211) != 0)
                .select(b.alias("payment_id"), b.alias("booking_id"),
                        F.col("base_price_usd").alias("amount_usd"),
                        F.when(m10 < 7, "Card").when(m10 == 7, "Points").when(m10 == 8, "Cash")
                         .otherwise("Voucher").alias("method"),
                        F.when(m20 < 13, "Captured").when(m20 < 16, "Authorized")
                         .when(m20 < 18, "Refunded").otherwise("Failed").alias("status"),
                        F.col("booking_date").alias("paid_at")))

    @cached_property
    def clv(self) -> DataFrame:
        """A row a customer (P-06): payments are joined and summed once for all that rank or add up customers."""
        return written(get_clv(self.bookings, self.payments), "clv")

    @cached_property
    def loyalty_accounts(self) -> DataFrame:
        c = self.table("customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
        seg = F.col("c_mktsegment")
        return (c.filter((F.col("c_custkey") % 5) < 3)
                 .select((F.col("c_custkey") + 1).alias("loyalty_id"),
                         F.col("c_custkey").alias("passenger_id"),
                         F.when(seg == "AUTOMOBILE", "Basic").when(seg == "BUILDING", "Silver")
                          .when(seg == "FURNITURE", "Gold").otherwise("Platinum").alias("tier"),
                         F.greatest(F.floor("c_acctbal"), F.lit(0)).cast("int").alias("miles_balance")))

    @cached_property
    def miles_transactions(self) -> DataFrame:
        o = self.table("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                  "o_orderdate"])
        la = self.loyalty_accounts.select("loyalty_id", "passenger_id")
        st = F.col("o_orderstatus")
        sign = F.when(st == "P", F.lit(-1)).otherwise(F.lit(1))
        return (o.join(la, o.o_custkey == la.passenger_id)
                 .select(F.col("o_orderkey").alias("miles_txn_id"), "loyalty_id",
                         F.col("o_orderkey").alias("flight_id"),
                         F.when(st == "P", "REDEEM").when(st == "F", "EARN")
                          .otherwise("ADJUST").alias("txn_type"),
                         (sign * F.floor(F.col("o_totalprice") / 15)).cast("int").alias("miles_delta"),
                         F.col("o_orderdate").alias("posted_at")))

    @cached_property
    def flight_performance(self) -> DataFrame:
        li = self.table("lineitem", ["l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus",
                                     "l_linenumber", "l_quantity"])
        s = self.table("supplier", ["s_suppkey", "s_nationkey"])
        flag = F.col("l_returnflag")

        def count_if(cond):
            return F.sum(F.when(cond, 1).otherwise(0)).cast("int")

        def minutes(line):
            return F.sum(F.when((F.col("l_linenumber") % 5) == line, F.col("l_quantity")).otherwise(F.lit(0.0)))

        return (li.join(s, li.l_suppkey == s.s_suppkey)
                  .groupBy(F.year("l_shipdate").cast("int").alias("year"),
                           F.month("l_shipdate").cast("int").alias("month"),
                           F.concat(F.lit("N"), _pad(F.col("s_nationkey"), 2)).alias("airline_iata"),
                           F.concat(F.lit("S"), _pad(F.col("l_suppkey"), 4)).alias("airport_iata"))
                  .agg(F.count(F.lit(1)).cast("int").alias("arrivals"),
                       count_if(flag == "R").alias("arrivals_delayed_15min"),
                       count_if((flag == "A") & (F.col("l_linestatus") == "F")).alias("arr_cancelled"),
                       count_if((flag == "N") & (F.col("l_linenumber") == 1)).alias("arr_diverted"),
                       F.sum("l_quantity").alias("total_arrival_delay_min"),
                       minutes(0).alias("carrier_delay"), minutes(1).alias("weather_delay"),
                       minutes(2).alias("nas_delay"), minutes(3).alias("security_delay"),
                       minutes(4).alias("late_aircraft_delay")))

    @cached_property
    def aircraft(self) -> DataFrame:
        p = self.table("part", ["p_partkey", "p_brand", "p_type", "p_size"])
        k = F.col("p_partkey")
        return p.select(k.alias("aircraft_id"), F.col("p_brand").alias("manufacturer"), F.col("p_type").alias("model"),
                        F.col("p_size").alias("seat_capacity"),
                        F.when((k % 10) != 0, F.concat(F.lit("T"), k.cast("string"))).alias("tail_number"))

    @cached_property
    def flight_changes(self) -> DataFrame:
        """The returned lines of an order, as changes of its flight's aircraft."""
        li = self.table("lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag"])
        line, part = F.col("l_linenumber"), F.col("l_partkey")
        return li.filter(F.col("l_returnflag") == "R").select(
            (F.col("l_orderkey") * 8 + line).alias("change_id"), F.col("l_orderkey").alias("flight_id"),
            F.when((line % 2) == 0, part).alias("old_aircraft_id"),
            F.when((F.col("l_orderkey") % 139) == 0, F.lit(-3).cast("bigint")).otherwise(part).alias("new_aircraft_id"),
            F.col("l_shipdate").alias("changed_at"))

    # ------------------------------------- tables with all declared columns
    @cached_property
    def airports_checked(self) -> DataFrame:
        k = F.col("airport_id")
        return (self.airports_dirty.join(self.airports.select("airport_id", "icao_code"), "airport_id")
                .withColumn("name", F.when((k % 23) != 5, F.col("name")))
                .withColumn("longitude", F.when((k % 19) == 0, F.lit(200.0)).otherwise(F.lit(20.0))))

    @cached_property
    def routes_checked(self) -> DataFrame:
        k = F.col("route_id")
        return self.routes.withColumn("distance_nm", F.when((k % 7) == 3, F.lit(-1).cast("bigint"))
                                      .when((k % 5) > 0, k % 3000).cast("int"))

    @cached_property
    def flights_checked(self) -> DataFrame:
        k, day = F.col("flight_id"), F.col("flight_date").cast("timestamp_ntz")
        more = self.flights.select(
            "flight_id", F.when((k % 131) == 0, F.lit(-2).cast("bigint")).otherwise(F.col("aircraft_id")).alias("aircraft_id"),
            "route_id", "flight_number", "flight_date",
            (day + F.make_dt_interval(F.lit(0), (5 + k % 18).cast("int"))).alias("scheduled_departure_utc"),
            F.when((k % 137) != 0, day + F.make_dt_interval(F.lit(0), (7 + k % 21).cast("int"))).alias("scheduled_arrival_utc"))
        return self.flights_orphan.join(more, "flight_id")

    @cached_property
    def passengers_checked(self) -> DataFrame:
        c = self.table("customer", ["c_custkey", "c_name", "c_mktsegment"])
        since = F.lit("1995-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("c_custkey") % 900).cast("int"))
        return c.select(F.col("c_custkey").alias("passenger_id"), F.col("c_name").alias("first_name"),
                        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("last_name"),
                        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"), since.alias("created_at"))

    @cached_property
    def payments_checked(self) -> DataFrame:
        # payment_id numbers the rows: the view joins each row of payments_orphan with itself
        return self.payments.select("payment_id", *[e.alias(c) for c, e in self._orphan_payment().items()], "status", "paid_at",
                                    F.when((F.col("payment_id") % 149) == 0, F.lit("Barter")).otherwise(F.col("method")).alias("method"))

    @cached_property
    def loyalty_checked(self) -> DataFrame:
        k = F.col("loyalty_id")
        since = F.lit("1996-01-01").cast("timestamp_ntz") + F.make_dt_interval((k % 700).cast("int"))
        return self.loyalty_accounts.withColumn("enrolled_at", F.when((k % 29) != 0, since))

    @cached_property
    def performance_checked(self) -> DataFrame:
        return self.flight_performance.withColumn("snapshot_id", F.concat_ws("-", "year", "month", "airline_iata", "airport_iata"))

    # ------------------------------------------------------- dirty fixtures
    @cached_property
    def airports_dirty(self) -> DataFrame:
        s = self.table("supplier", ["s_suppkey"])
        k = F.col("s_suppkey")
        m = k % 10
        code = (F.when(m == 0, "").when(m == 1, " ").when(m == 2, "NA")
                 .when(m == 3, F.lit("\\N")).when(m == 4, "  ").when(m == 5, " na ")
                 .otherwise(F.concat(F.lit(" s"), k.cast("string"), F.lit(" "))))
        return s.select(k.alias("airport_id"), code.alias("iata_code"),
                        F.concat(F.lit("  o'brien MARY-ANN "), k.cast("string")).alias("name"),
                        F.when((k % 13) == 0, F.lit(95.0)).otherwise(F.lit(10.0))
                         .cast("decimal(3,1)").alias("latitude"))

    @cached_property
    def flights_orphan(self) -> DataFrame:
        fid = F.col("flight_id")
        return self.flights.select(
            "flight_id",
            F.when((fid % 101) == 0, F.lit(999).cast("bigint")).otherwise(F.col("airline_id")).alias("airline_id"),
            F.when((fid % 103) == 0, F.lit(-1).cast("bigint")).otherwise(F.col("origin_airport_id")).alias("origin_airport_id"),
            "destination_airport_id",
            F.when((fid % 107) == 0, F.lit(-5)).otherwise(F.col("delay_minutes")).alias("delay_minutes"),
            F.when((fid % 109) == 0, F.lit("cancelled")).otherwise(F.col("status")).alias("status"))

    @cached_property
    def payments_orphan(self) -> DataFrame:
        return self.payments.select("payment_id", *[e.alias(c) for c, e in self._orphan_payment().items()], "status")

    @staticmethod
    def _orphan_payment() -> dict:
        pid = F.col("payment_id")
        return {"booking_id": F.when((pid % 113) == 0, -pid).otherwise(F.col("booking_id")),
                "amount_usd": F.when((pid % 127) == 0, -F.col("amount_usd")).otherwise(F.col("amount_usd"))}

    @cached_property
    def multikey_candidates(self) -> DataFrame:
        s = self.table("supplier", ["s_suppkey"])
        k = F.col("s_suppkey")
        blk = F.floor(k / 8).cast("int").cast("string")
        return s.select(
            k.alias("ord"),
            F.when((k % 9) != 8, F.concat(F.lit("I"), blk, F.lit("_"),
                                          F.floor((k % 8) / 2).cast("int").cast("string"))).alias("iata_code"),
            F.when((k % 11) != 10, F.concat(F.lit("C"), blk, F.lit("_"),
                                            F.floor((k % 8 + 1) / 2).cast("int").cast("string"))).alias("icao_code"))
