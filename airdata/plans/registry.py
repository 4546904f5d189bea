"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the driver tables through ``Fixtures``; the oracle is independent SQL over the
raw tables (fixture views inlined as CTEs).
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from airdata.session import checkpoint_dir
from airdata.sources.fixtures import Fixtures
from airdata.sources.tables import scan_table


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Fixtures], DataFrame]
    oracle: str | None
    survey_id: str


REGISTRY: dict[str, Query] = {}


def query(name: str, survey_id: str, oracle: str | None = None):
    def deco(fn: Callable[[Fixtures], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, survey_id)
        return fn
    return deco


# One set of derived airline tables per (session, data directory): the keyed
# tables (routes, bookings) are materialised once and shared by every query
# of the catalogue, as loaded tables would be.
# Files written anew have other names, and get derived tables of their own.
_FIXTURES: "weakref.WeakKeyDictionary[SparkSession, dict[tuple, Fixtures]]" = weakref.WeakKeyDictionary()
_INPUTS = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def fixtures_for(spark: SparkSession, sf_dir: str) -> Fixtures:
    per_session = _FIXTURES.setdefault(spark, {})
    files = tuple(f for t in _INPUTS for f in sorted(scan_table(spark, sf_dir, t).inputFiles()))
    fx = per_session.get((sf_dir, files))
    if fx is None:
        fx = per_session[sf_dir, files] = Fixtures(spark, sf_dir)
    return fx


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checkpoint_dir(spark)   # uses the session's setting; sets one only if unset
        return q.build(fixtures_for(spark, sf_dir))
    run.__name__ = q.name
    return run
