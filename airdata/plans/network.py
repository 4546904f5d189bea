"""Catalogue entries for the route network (A-15 .. A-17) on the whole routes table.

The oracle joins the legs three times; parallel routes are rows there, and a
counted multiplicity on the Spark side.
"""

from __future__ import annotations

from airdata.operators import network as N
from airdata.plans.registry import query
from airdata.plans.views_sql import with_views as W

_HUB_SQL = """
hub AS (
  SELECT origin_airport_id AS hub_id, count(*) AS out_routes FROM routes
  GROUP BY ALL ORDER BY out_routes DESC, hub_id LIMIT 1)"""


def _hops_sql(routes: str) -> str:
    """One table a number of hops: start code, codes on the way, last airport."""
    return f"""{_HUB_SQL.strip()},
leg AS (
  SELECT o.airport_id AS src, o.iata_code AS src_code, d.airport_id AS dst, d.iata_code AS dst_code
  FROM {routes} e JOIN airports o ON o.airport_id = e.origin_airport_id
  JOIN airports d ON d.airport_id = e.destination_airport_id),
hop1 AS (SELECT src_code AS s, dst_code AS a, dst AS last FROM leg, hub WHERE src = hub_id),
hop2 AS (SELECT s, a, dst_code AS b, dst AS last FROM hop1 JOIN leg ON src = last
         WHERE dst_code <> s AND dst_code <> a),
hop3 AS (SELECT s, a, b, dst_code AS c, dst AS last FROM hop2 JOIN leg ON src = last
         WHERE dst_code <> s AND dst_code <> a AND dst_code <> b),
walks AS (
  SELECT s AS origin_iata, a AS dest_iata, 1 AS hops, s || '>' || a AS path FROM hop1
  UNION ALL SELECT s, b, 2, s || '>' || a || '>' || b FROM hop2
  UNION ALL SELECT s, c, 3, s || '>' || a || '>' || b || '>' || c FROM hop3)"""


@query("busiest_origin", "A-15", W(f"""
WITH {_HUB_SQL.strip()}
SELECT hub_id AS airport_id, iata_code, out_routes AS route_count
FROM hub, airports WHERE airport_id = hub_id""", "routes", "airports"))
def _busiest_origin(fx):
    return N.busiest_origin(fx.routes, fx.airports)


@query("connectivity_3hop", "A-16", W(f"""
WITH pairs AS (SELECT DISTINCT origin_airport_id, destination_airport_id FROM routes),
{_hops_sql("pairs").strip()}
SELECT DISTINCT * FROM walks ORDER BY hops, dest_iata, path LIMIT 200""", "routes", "airports"))
def _connectivity_3hop(fx):
    return N.connectivity_3hop(fx.routes, fx.airports)


@query("multihop_paths", "A-17", W(f"""
WITH {_hops_sql("routes").strip()}
SELECT * FROM walks ORDER BY hops DESC, dest_iata, path LIMIT 50""", "routes", "airports"))
def _multihop_paths(fx):
    return N.multihop_paths(fx.routes, fx.airports)
