"""The full query catalogue (imports every plan module so it registers)."""

from __future__ import annotations

from airdata.plans import (analytics, cleaning, constraints, ingest, maintain, network, quality,  # noqa: F401
                           reports, roundtrip, windows)
from airdata.plans.registry import REGISTRY, runner


def queries():
    return {name: runner(q) for name, q in REGISTRY.items()}


def oracle_sql():
    return {name: q.oracle for name, q in REGISTRY.items() if q.oracle is not None}
