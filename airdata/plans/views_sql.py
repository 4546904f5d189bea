"""Oracle side: the airline views of FIXTURES.md §5-§6 as portable SQL.

These strings are used only to build the independent DuckDB oracle queries
(as CTEs over the driver's raw tables). The Spark side computes the same views
with DataFrame code in ``airdata.sources.fixtures``.
"""

from __future__ import annotations

# view name -> (SQL body, views it depends on)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "airlines": ("""
select cast(n_nationkey as bigint) as airline_id, n_name as name,
       concat('N', lpad(cast(n_nationkey as string), greatest(2, cast(length(cast(n_nationkey as string)) as int)), '0')) as iata_code,
       concat('A', lpad(cast(n_nationkey as string), greatest(2, cast(length(cast(n_nationkey as string)) as int)), '0')) as icao_code,
       r_name as country
from nation join region on n_regionkey = r_regionkey""", ()),
    "airports": ("""
select s_suppkey as airport_id,
       concat('S', lpad(cast(s_suppkey as string), greatest(4, cast(length(cast(s_suppkey as string)) as int)), '0')) as iata_code,
       concat('K', lpad(cast(s_suppkey as string), greatest(4, cast(length(cast(s_suppkey as string)) as int)), '0')) as icao_code,
       s_name as name, concat('Country ', cast(s_nationkey as string)) as country,
       case when s_suppkey % 17 = 16 then null else cast((s_suppkey * 37) % 181 - 90 as decimal(8,5)) end as latitude,
       case when s_suppkey % 17 = 16 then null else cast((s_suppkey * 73) % 361 - 180 as decimal(8,5)) end as longitude
from supplier""", ()),
    "od": ("""
select l_orderkey, min(l_suppkey) as lo, max(l_suppkey) as hi, min(l_partkey) as part
from lineitem group by l_orderkey having min(l_suppkey) <> max(l_suppkey)""", ()),
    "flights_base": ("""
select o_orderkey as flight_id, o_orderkey % 25 as airline_id,
       case when o_orderkey % 2 = 0 then lo else hi end as origin_airport_id,
       case when o_orderkey % 2 = 0 then hi else lo end as destination_airport_id,
       concat('N', lpad(cast(o_orderkey % 25 as string), greatest(2, cast(length(cast(o_orderkey % 25 as string)) as int)), '0'), lpad(cast(o_orderkey % 9999 as string), greatest(4, cast(length(cast(o_orderkey % 9999 as string)) as int)), '0')) as flight_number,
       cast(o_orderdate as date) as flight_date, case when o_orderkey % 9 <> 4 then part end as aircraft_id,
       cast(case when o_orderkey % 50 = 49 then null
            when o_orderpriority = '4-NOT SPECIFIED' then 60 + o_orderkey % 241
            when o_orderpriority = '1-URGENT' then 0
            else (o_orderkey * 7) % 181 end as int) as delay_minutes,
       case o_orderpriority when '1-URGENT' then 'Scheduled' when '2-HIGH' then 'Departed'
            when '3-MEDIUM' then 'Arrived' when '4-NOT SPECIFIED' then 'Cancelled' else 'Diverted' end as status
from orders join od on l_orderkey = o_orderkey""", ("od",)),
    "routes": ("""
select row_number() over (order by airline_id, origin_airport_id, destination_airport_id) as route_id,
       airline_id, origin_airport_id, destination_airport_id
from (select distinct airline_id, origin_airport_id, destination_airport_id from flights_base) t""",
               ("flights_base",)),
    "flights": ("""
select f.flight_id, f.airline_id, f.aircraft_id, r.route_id, f.origin_airport_id, f.destination_airport_id,
       f.flight_number, f.flight_date, f.delay_minutes, f.status
from flights_base f left join routes r
  on r.airline_id = f.airline_id and r.origin_airport_id = f.origin_airport_id
 and r.destination_airport_id = f.destination_airport_id and f.flight_id % 40 <> 0""",
                ("flights_base", "routes")),
    "passengers": ("""
select c_custkey as passenger_id, c_name as first_name,
       concat(lower(c_name), '@example.com') as email
from customer""", ()),
    "bookings": ("""
select row_number() over (order by l_partkey, l_orderkey) as booking_id,
       l_partkey as passenger_id, l_orderkey as flight_id, min(l_shipdate) as booking_date,
       case max(l_linenumber) % 5 when 0 then 'Basic' when 1 then 'Standard' when 2 then 'Flexible'
            when 3 then 'Business' else 'First' end as fare_class,
       cast(min(l_extendedprice) as decimal(10,2)) as base_price_usd,
       case min(l_suppkey) % 4 when 0 then 'Web' when 1 then 'Mobile' when 2 then 'Call Center'
            else 'Travel Agent' end as booking_channel
from lineitem join customer on l_partkey = c_custkey join flights_base on flight_id = l_orderkey
group by l_partkey, l_orderkey""", ("flights_base",)),
    "payments": ("""
select booking_id as payment_id, booking_id, base_price_usd as amount_usd,
       case when booking_id % 10 < 7 then 'Card' when booking_id % 10 = 7 then 'Points'
            when booking_id % 10 = 8 then 'Cash' else 'Voucher' end as method,
       case when booking_id % 20 < 13 then 'Captured' when booking_id % 20 < 16 then 'Authorized'
            when booking_id % 20 < 18 then 'Refunded' else 'Failed' end as status,
       booking_date as paid_at
from bookings where booking_id % 211 <> 0""", ("bookings",)),
    "loyalty_accounts": ("""
select c_custkey + 1 as loyalty_id, c_custkey as passenger_id,
       case c_mktsegment when 'AUTOMOBILE' then 'Basic' when 'BUILDING' then 'Silver'
            when 'FURNITURE' then 'Gold' else 'Platinum' end as tier,
       cast(greatest(floor(c_acctbal), 0) as int) as miles_balance
from customer where c_custkey % 5 < 3""", ()),
    "miles_transactions": ("""
select o_orderkey as miles_txn_id, loyalty_id, o_orderkey as flight_id,
       case o_orderstatus when 'P' then 'REDEEM' when 'F' then 'EARN' else 'ADJUST' end as txn_type,
       cast(case when o_orderstatus = 'P' then -1 else 1 end * floor(o_totalprice / 15) as int) as miles_delta,
       o_orderdate as posted_at
from orders join loyalty_accounts on passenger_id = o_custkey""", ("loyalty_accounts",)),
    "flight_performance": ("""
select cast(year(l_shipdate) as int) as year, cast(month(l_shipdate) as int) as month,
       concat('N', lpad(cast(s_nationkey as string), greatest(2, cast(length(cast(s_nationkey as string)) as int)), '0')) as airline_iata,
       concat('S', lpad(cast(l_suppkey as string), greatest(4, cast(length(cast(l_suppkey as string)) as int)), '0')) as airport_iata,
       cast(count(*) as int) as arrivals,
       cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as int) as arrivals_delayed_15min,
       cast(sum(case when l_returnflag = 'A' and l_linestatus = 'F' then 1 else 0 end) as int) as arr_cancelled,
       cast(sum(case when l_returnflag = 'N' and l_linenumber = 1 then 1 else 0 end) as int) as arr_diverted,
       sum(l_quantity) as total_arrival_delay_min,
       sum(case when l_linenumber % 5 = 0 then l_quantity else 0 end) as carrier_delay,
       sum(case when l_linenumber % 5 = 1 then l_quantity else 0 end) as weather_delay,
       sum(case when l_linenumber % 5 = 2 then l_quantity else 0 end) as nas_delay,
       sum(case when l_linenumber % 5 = 3 then l_quantity else 0 end) as security_delay,
       sum(case when l_linenumber % 5 = 4 then l_quantity else 0 end) as late_aircraft_delay
from lineitem join supplier on l_suppkey = s_suppkey
group by 1, 2, 3, 4""", ()),
    "aircraft": ("""
select p_partkey as aircraft_id, p_brand as manufacturer, p_type as model, p_size as seat_capacity,
       case when p_partkey % 10 <> 0 then concat('T', cast(p_partkey as string)) end as tail_number
from part""", ()),
    "flight_changes": ("""
select l_orderkey * 8 + l_linenumber as change_id, l_orderkey as flight_id,
       case when l_linenumber % 2 = 0 then l_partkey end as old_aircraft_id,
       case when l_orderkey % 139 = 0 then -3 else l_partkey end as new_aircraft_id,
       l_shipdate as changed_at
from lineitem where l_returnflag = 'R'""", ()),
    "airports_checked": ("""
select d.airport_id, d.iata_code, a.icao_code, case when d.airport_id % 23 <> 5 then d.name end as name, d.latitude,
       case when d.airport_id % 19 = 0 then 200.0 else 20.0 end as longitude
from airports_dirty d join airports a on a.airport_id = d.airport_id""", ("airports_dirty", "airports")),
    "routes_checked": ("""
select *, cast(case when route_id % 7 = 3 then -1 when route_id % 5 > 0 then route_id % 3000 end as int) as distance_nm
from routes""", ("routes",)),
    "flights_checked": ("""
select o.flight_id, o.airline_id, o.origin_airport_id, o.destination_airport_id, o.delay_minutes, o.status,
       case when f.flight_id % 131 = 0 then -2 else f.aircraft_id end as aircraft_id, f.route_id, f.flight_number,
       f.flight_date, cast(f.flight_date as timestamp) + to_hours(cast(5 + f.flight_id % 18 as int)) as scheduled_departure_utc,
       case when f.flight_id % 137 <> 0 then cast(f.flight_date as timestamp)
         + to_hours(cast(7 + f.flight_id % 21 as int)) end as scheduled_arrival_utc
from flights_orphan o join flights f on f.flight_id = o.flight_id""", ("flights_orphan", "flights")),
    "passengers_checked": ("""
select c_custkey as passenger_id, c_name as first_name, nullif(c_mktsegment, 'MACHINERY') as last_name,
       concat(lower(c_name), '@example.com') as email, timestamp '1995-01-01' + to_days(cast(c_custkey % 900 as int)) as created_at
from customer""", ()),
    "payments_checked": ("""
select o.payment_id, o.booking_id, o.amount_usd, o.status,
       case when p.payment_id % 149 = 0 then 'Barter' else p.method end as method, p.paid_at
from payments_orphan o join payments p on p.payment_id = o.payment_id""", ("payments_orphan", "payments")),
    "loyalty_checked": ("""
select *, case when loyalty_id % 29 <> 0 then timestamp '1996-01-01' + to_days(cast(loyalty_id % 700 as int)) end as enrolled_at
from loyalty_accounts""", ("loyalty_accounts",)),
    "performance_checked": ("""
select *, concat(cast(year as string), '-', cast(month as string), '-', airline_iata, '-', airport_iata) as snapshot_id
from flight_performance""", ("flight_performance",)),
    "airports_dirty": ("""
select s_suppkey as airport_id,
       case s_suppkey % 10 when 0 then '' when 1 then ' ' when 2 then 'NA' when 3 then concat(chr(92), 'N')
            when 4 then '  ' when 5 then ' na ' else concat(' s', cast(s_suppkey as string), ' ') end as iata_code,
       concat('  o''brien MARY-ANN ', cast(s_suppkey as string)) as name,
       case when s_suppkey % 13 = 0 then 95.0 else 10.0 end as latitude
from supplier""", ()),
    "flights_orphan": ("""
select flight_id, case when flight_id % 101 = 0 then 999 else airline_id end as airline_id,
       case when flight_id % 103 = 0 then -1 else origin_airport_id end as origin_airport_id,
       destination_airport_id,
       case when flight_id % 107 = 0 then -5 else delay_minutes end as delay_minutes,
       case when flight_id % 109 = 0 then 'cancelled' else status end as status
from flights""", ("flights",)),
    "payments_orphan": ("""
select payment_id, case when payment_id % 113 = 0 then -payment_id else booking_id end as booking_id,
       case when payment_id % 127 = 0 then -amount_usd else amount_usd end as amount_usd, status
from payments""", ("payments",)),
    "multikey_candidates": ("""
select s_suppkey as ord,
       case when s_suppkey % 9 = 8 then null else concat('I', cast(floor(s_suppkey / 8) as int), '_', cast(floor((s_suppkey % 8) / 2) as int)) end as iata_code,
       case when s_suppkey % 11 = 10 then null else concat('C', cast(floor(s_suppkey / 8) as int), '_', cast(floor((s_suppkey % 8 + 1) / 2) as int)) end as icao_code
from supplier""", ()),
}


def _closure(names) -> list[str]:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def with_views(body: str, *views: str) -> str:
    """``WITH <views and their dependencies> <body>`` for the DuckDB oracle."""
    names = _closure(views)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][0].strip()})" for n in names)
    body = body.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
