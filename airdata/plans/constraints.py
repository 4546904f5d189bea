"""Catalogue entries for constraint validation (V-01 .. V-09).

Checks run on a mix of clean and dirty fixtures so that violations exist.
The oracle SQL for each check kind is the textbook query (count of rows
failing the predicate, GROUP BY ... HAVING count(*) > 1, LEFT JOIN ... IS
NULL), written per constraint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from airdata.functions.scalar import with_scalar
from airdata import schema as S
from airdata.operators import constraints as V
from airdata.plans.registry import query
from airdata.plans.views_sql import with_views as W

# logical table -> fixture view that has every column a constraint names
CHECK_VIEWS = {
    "airports": "airports_checked", "airlines": "airlines", "aircraft": "aircraft", "routes": "routes_checked",
    "flights": "flights_checked", "flight_changes": "flight_changes", "passengers": "passengers_checked",
    "bookings": "bookings", "payments": "payments_checked", "loyalty_accounts": "loyalty_checked",
    "miles_transactions": "miles_transactions", "flight_performance": "performance_checked",
    "multikey": "multikey_candidates",
}


def _tables(fx):
    return {t: getattr(fx, v) for t, v in CHECK_VIEWS.items() if t != "multikey"}


def _head(name, table, ctype):
    return (f"SELECT '{name}' AS check_name, '{table}' AS table_name, "
            f"'{ctype}' AS constraint_type, ")


def sql_not_null(c: S.NotNull):
    return (_head(c.name, c.table, "NOT NULL")
            + f"count(*) FILTER (WHERE {c.column} IS NULL) AS violations FROM {CHECK_VIEWS[c.table]}")


def sql_check(c: S.Check):
    return (_head(c.name, c.table, "CHECK")
            + f"count(*) FILTER (WHERE NOT ({c.predicate})) AS violations FROM {CHECK_VIEWS[c.table]}")


def sql_domain(d: S.Domain):
    vals = ", ".join(f"'{v}'" for v in d.values)
    return (_head(d.name, d.table, "DOMAIN")
            + f"count(*) FILTER (WHERE {d.column} IS NOT NULL AND {d.column} NOT IN ({vals})) "
            f"AS violations FROM {CHECK_VIEWS[d.table]}")


def sql_unique(u: S.Unique):
    cols = ", ".join(u.columns)
    conds = " AND ".join(f"{c} IS NOT NULL" for c in sorted(set(u.columns) | set(u.where_not_null)))
    return (_head(u.name, u.table, "UNIQUE")
            + f"count(*) AS violations FROM (SELECT {cols} FROM {CHECK_VIEWS[u.table]} "
            f"WHERE {conds} GROUP BY {cols} HAVING count(*) > 1) t")


def sql_fk(fk: S.ForeignKey):
    on = " AND ".join(f"c.{a} = p.{b}" for a, b in zip(fk.columns, fk.parent_columns))
    nn = " AND ".join(f"c.{a} IS NOT NULL" for a in fk.columns)
    return (_head(fk.name, fk.child, "FOREIGN KEY")
            + f"count(*) AS violations FROM {CHECK_VIEWS[fk.child]} c "
            f"LEFT JOIN {CHECK_VIEWS[fk.parent]} p ON {on} "
            f"WHERE {nn} AND p.{fk.parent_columns[0]} IS NULL")


def _union_sql(parts):
    return "\nUNION ALL\n".join(parts)


def _views_for(items):
    names = set()
    for c in items:
        for attr in ("table", "child", "parent"):
            t = getattr(c, attr, None)
            if t:
                names.add(CHECK_VIEWS[t])
    return sorted(names)


# Every declared constraint; a CHECK that names two columns compares them.
NN, UNIQ, FKS, DOMS = S.NOT_NULL, S.UNIQUES, S.FOREIGN_KEYS, S.DOMAINS
CROSS = tuple(c for c in S.CHECKS if c.name in ("chk_routes_origin_dest", "chk_flights_sched", "chk_flights_origin_dest"))
RANGE = tuple(c for c in S.CHECKS if c not in CROSS)


def _local(fx, items, fn):
    t = _tables(fx)
    by = {}
    for c in items:
        by.setdefault(c.table, []).append(c)
    return V._report([fn(t[tab], tab, cs) for tab, cs in by.items()])


@query("check_not_null", "V-01", W(_union_sql([sql_not_null(c) for c in NN]), *_views_for(NN)))
def _check_not_null(fx):
    return _local(fx, NN, lambda df, t, cs: V.check_not_null(df, t, [c.column for c in cs]))


@query("check_range", "V-02", W(_union_sql([sql_check(c) for c in RANGE]), *_views_for(RANGE)))
def _check_range(fx):
    return _local(fx, RANGE, V.check_range)


@query("check_cross_column", "V-03", W(_union_sql([sql_check(c) for c in CROSS]), *_views_for(CROSS)))
def _check_cross_column(fx):
    return _local(fx, CROSS, V.check_range)


@query("check_unique", "V-04", W(_union_sql([sql_unique(u) for u in UNIQ]), *_views_for(UNIQ)))
def _check_unique(fx):
    return V.constraint_report(_tables(fx), uniques=UNIQ)


_MK = (S.Unique("multikey", ("iata_code",), "uq_multikey_iata", ("iata_code",)),
       S.Unique("multikey", ("icao_code",), "uq_multikey_icao", ("icao_code",)))


@query("check_unique_when_present", "V-05", W(_union_sql([sql_unique(u) for u in _MK]),
                                              "multikey_candidates"))
def _check_unique_when_present(fx):
    return V._report([V.check_unique(fx.multikey_candidates, u) for u in _MK])


@query("check_foreign_key", "V-06", W(_union_sql([sql_fk(fk) for fk in FKS]), *_views_for(FKS)))
def _check_foreign_key(fx):
    return V.constraint_report(_tables(fx), foreign_keys=FKS)


@query("check_domain", "V-07", W(_union_sql([sql_domain(d) for d in DOMS]), *_views_for(DOMS)))
def _check_domain(fx):
    return _local(fx, DOMS, V.check_domain)


_ALL = NN + RANGE + CROSS + DOMS


@query("constraint_report", "V-09", W(
    _union_sql([sql_not_null(c) for c in NN] + [sql_check(c) for c in RANGE + CROSS]
               + [sql_domain(d) for d in DOMS] + [sql_unique(u) for u in UNIQ]
               + [sql_fk(fk) for fk in FKS]),
    *sorted(set(_views_for(_ALL)) | set(_views_for(UNIQ)) | set(_views_for(FKS)))))
def _constraint_report(fx):
    return V.constraint_report(_tables(fx), not_null=NN, checks=RANGE + CROSS, uniques=UNIQ,
                               foreign_keys=FKS, domains=DOMS)


# V-08: delete every 7th passenger and every 11th flight in one call over the
# graph of foreign keys: passengers -> bookings -> payments, passengers ->
# loyalty -> miles, flights -> bookings.flight_id / miles.flight_id (SET NULL).
# Deleting airlines is refused by the flights that refer to them.
def _fk_actions(fx):
    from pyspark.sql import functions as F
    names = ("bookings", "payments", "loyalty_accounts", "miles_transactions")
    before = {n: getattr(fx, n) for n in names} | {"passengers": fx.passengers, "flights": fx.flights_base}
    after = V.delete_rows(before, S.FOREIGN_KEYS, {
        "passengers": fx.passengers.filter(F.col("passenger_id") % 7 == 0).select("passenger_id"),
        "flights": fx.flights_base.filter(F.col("flight_id") % 11 == 0).select("flight_id")})

    def summary(name, key):
        counts = after[name].agg(F.count(F.lit(1)).alias("rows_after"),
                                 F.count_if(F.col(key).isNull()).alias("keys_nulled"))
        return (with_scalar(counts, before[name].agg(F.count(F.lit(1)).alias("_before")))
                .select(F.lit(name).alias("table_name"), "rows_after",
                        (F.col("_before") - F.col("rows_after")).alias("rows_removed"), "keys_nulled"))

    try:
        V.delete_rows({"airlines": fx.airlines, "flights": fx.flights_base}, S.FOREIGN_KEYS,
                      {"airlines": fx.airlines.filter(F.col("airline_id") % 5 == 0).select("airline_id")})
        blocking = 0
    except V.Restricted as e:
        blocking = e.blocking["fk_flights_airline"]
    refused = fx.spark.range(1).select(F.lit("flights (restricting)").alias("table_name"), F.lit(blocking).cast("bigint").alias("rows_after"),
                                       F.lit(0).cast("bigint").alias("rows_removed"), F.lit(0).cast("bigint").alias("keys_nulled"))
    return reduce(DataFrame.unionByName, [summary(n, k) for n, k in zip(names, ("flight_id", "booking_id", "passenger_id", "flight_id"))] + [refused])


_FK_ACTIONS_SQL = """
WITH gone_pax AS (SELECT passenger_id FROM passengers WHERE passenger_id % 7 = 0),
gone_flights AS (SELECT flight_id FROM flights_base WHERE flight_id % 11 = 0),
b1 AS (SELECT * FROM bookings WHERE passenger_id NOT IN (SELECT passenger_id FROM gone_pax)),
p1 AS (SELECT * FROM payments WHERE booking_id IN (SELECT booking_id FROM b1)),
l1 AS (SELECT * FROM loyalty_accounts WHERE passenger_id NOT IN (SELECT passenger_id FROM gone_pax)),
m1 AS (SELECT * FROM miles_transactions WHERE loyalty_id IN (SELECT loyalty_id FROM l1)),
b2 AS (SELECT booking_id, CASE WHEN flight_id IN (SELECT flight_id FROM gone_flights) THEN NULL
              ELSE flight_id END AS flight_id FROM b1),
m2 AS (SELECT miles_txn_id, CASE WHEN flight_id IN (SELECT flight_id FROM gone_flights) THEN NULL
              ELSE flight_id END AS flight_id FROM m1)
SELECT 'bookings' AS table_name, count(*) AS rows_after,
       (SELECT count(*) FROM bookings) - count(*) AS rows_removed,
       count(*) FILTER (WHERE flight_id IS NULL) AS keys_nulled FROM b2
UNION ALL SELECT 'payments', count(*), (SELECT count(*) FROM payments) - count(*),
       count(*) FILTER (WHERE booking_id IS NULL) FROM p1
UNION ALL SELECT 'loyalty_accounts', count(*), (SELECT count(*) FROM loyalty_accounts) - count(*),
       count(*) FILTER (WHERE passenger_id IS NULL) FROM l1
UNION ALL SELECT 'miles_transactions', count(*), (SELECT count(*) FROM miles_transactions) - count(*),
       count(*) FILTER (WHERE flight_id IS NULL) FROM m2
UNION ALL SELECT 'flights (restricting)', count(*), 0, 0 FROM flights_base WHERE airline_id % 5 = 0"""


@query("apply_fk_action", "V-08", W(_FK_ACTIONS_SQL, "passengers", "flights_base", "bookings",
                                     "payments", "loyalty_accounts", "miles_transactions"))
def _apply_fk_action(fx):
    return _fk_actions(fx)
