"""The loaded (bucketed) warehouse gives the same answers as the on-the-fly
fixtures, and the bucketed fact pairs join without a shuffle."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from airdata.operators.metrics import lifetime_miles
from airdata.plans import catalog  # noqa: F401
from airdata.plans.registry import REGISTRY
from airdata.sources.fixtures import Fixtures
from airdata.sources.warehouse import Warehouse, build_warehouse


def test_warehouse_matches_fixtures(spark, sf_dir, tmp_dir):
    root = build_warehouse(spark, sf_dir, os.path.join(tmp_dir, "wh"))
    wh = Warehouse(spark, sf_dir, root)
    fx = Fixtures(spark, sf_dir)
    for name in ("revenue_by_fare_class", "clv_running", "top_loyalty_5pct", "busiest_airports"):
        a = REGISTRY[name].build(wh)
        b = REGISTRY[name].build(fx)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    # bucketed on the join key: aggregating miles per account and joining the
    # accounts needs no hash exchange
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            lifetime_miles(wh.loyalty_accounts, wh.miles_transactions).explain()
        assert "Exchange hashpartitioning" not in buf.getvalue()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert wh.bookings.agg(F.count("*")).first()[0] == fx.bookings.count()
