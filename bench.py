"""Benchmark: catalogue queries on the loaded warehouse.

Phase 1 (load) derives the airline tables from the driver tables at
$BENCH_SF_DIR and writes them as Parquet (timed as ``load_sec``). Phase 2
runs each headline query on the loaded tables: one warm-up, then the median
of $BENCH_RUNS (default 5) timed runs, each a full execution into a no-op sink. Prints one JSON
line. BENCH_ALL=1 times every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from airdata.plans import catalog  # noqa: E402,F401
from airdata.plans.registry import REGISTRY  # noqa: E402
from airdata.session import checkpoint_dir, get_session  # noqa: E402
from airdata.sources.warehouse import Warehouse, build_warehouse  # noqa: E402

# The 15 catalogued queries of the source plus the notebook helpers it times.
CATALOGUED = [
    "busiest_airports", "airline_on_time", "monthly_passengers", "loyalty_tier_transitions",
    "revenue_by_fare_class", "airline_delay_rank", "running_monthly_revenue",
    "pct_delayed_by_month", "clv_running", "route_distance_rank", "connectivity_3hop",
    "multihop_paths", "payment_success_by_channel", "worst_routes", "top_loyalty_5pct",
]
HEADLINE = CATALOGUED + [
    "get_busiest_airports", "get_top_customers", "clv_describe", "fk_orphans_cte",
    "constraint_report", "insert_ignore_pk", "apply_change_log",
]


RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def run_once(build) -> float:
    """Plan building (which may run small probe jobs) plus full execution."""
    t = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
             "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")}
    for kv in os.environ.get("BENCH_CONF", "").split(","):
        if "=" in kv:
            k, v = kv.split("=", 1)
            extra[k.strip()] = v.strip()
    spark = get_session(f"local[{cpus}]", int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                        app_name="airdata-bench", extra=extra)
    root = os.environ.get("BENCH_WAREHOUSE")
    load_sec = None
    if not root:
        base = tempfile.mkdtemp(prefix="airdata-bench-", dir=checkpoint_dir(spark))
        root = os.path.join(base, "warehouse")
        t0 = time.perf_counter()
        build_warehouse(spark, sf_dir, root)
        load_sec = round(time.perf_counter() - t0, 3)

    wh = Warehouse(spark, sf_dir, root)
    volumes = {t: getattr(wh, t).count() for t in ("flights", "bookings", "payments", "routes",
                                                  "flight_performance", "loyalty_accounts")}
    names = sorted(REGISTRY) if os.environ.get("BENCH_ALL") else HEADLINE
    times, errors = {}, {}
    for name in names:
        q = REGISTRY[name]
        try:
            def build():
                return q.build(Warehouse(spark, sf_dir, root))
            run_once(build)                                            # warm-up
            runs = [run_once(build) for _ in range(RUNS)]
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # noqa: BLE001 - report and continue
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    cat = [times[n] for n in CATALOGUED if n in times]
    out = {
        "metric": "slowest_catalogued_query_median",
        "value": max(cat) if cat else None,
        "unit": "sec",
        "queries": times,
        "total_sec": round(sum(times.values()), 3),
        "load_sec": load_sec,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": volumes,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
