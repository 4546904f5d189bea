"""Spark-vs-DuckDB comparison used by tests and scripts/check_oracle.py.

Mirrors the driver's gate: row count, column names, and an order-insensitive
comparison of values with columns sorted by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from airdata.sources.tables import DRIVER_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare_query(spark, sf_dir, fn, sql, con=None):
    sdf = fn(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    if sql is None:
        return True, f"rows={len(s_rows)} (no oracle)"
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(x != y for x, y in zip(a, b))} rows), e.g. {diff}"
    return True, f"rows={len(s_rows)}"
