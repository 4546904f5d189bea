"""
the physical plans."""

import contextlib
import io

import pytest

import __spark_entry__ as E


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_or_join_is_rewritten(spark, sf_dir, q):
    for name in ("get_busiest_airports", "get_airports_for_map"):
        p = plan(q[name](spark, sf_dir))
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_top_k_before_rank(spark, sf_dir, q):
    p = plan(q["route_distance_rank"](spark, sf_dir))
    assert "TakeOrderedAndProject" in p


def test_no_single_partition_window_over_facts(spark, sf_dir, q):
    # Running spend and top-percent members must not gather a fact table into
    # one partition (global windows run only over bounded inputs).
    for name in ("clv_running", "top_loyalty_5pct", "get_top_customers", "clv_lorenz"):
        p = plan(q[name](spark, sf_dir))
        for line in p.splitlines():
            if "Exchange SinglePartition" in line:
                raise AssertionError(f"{name}: {line}")


def test_filters_and_columns_reach_the_scan(spark, sf_dir, q):
    # flight performance reads only the lineitem columns it aggregates
    p = plan(q["airline_on_time"](spark, sf_dir))
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema:")]
    assert schemas and not any("l_extendedprice" in s or "l_tax" in s for s in schemas)
    # the flights fixture reads only the order columns it needs
    p = plan(q["flights_by_status"](spark, sf_dir))
    assert "o_totalprice" not in p and "o_custkey" not in p
    assert "PushedFilters" in p


def test_pre_aggregation_before_join(spark, sf_dir, q):
    p = plan(q["revenue_by_fare_class"](spark, sf_dir))
    # payments are summed per booking before the join: an aggregate sits
    # below the join on the payments side, and there is no distinct rewrite
    assert "Expand" not in p


def test_first_per_key_is_cut_before_the_shuffle(spark):
    from airdata.operators.keys import first_per_key
    p = plan(first_per_key(spark.range(100).selectExpr("id % 7 as k", "id"), ["k"], ["id"]))
    assert "WindowGroupLimit" in p and "SortAggregate" not in p


def test_high_water_mark_reaches_the_scan(spark, sf_dir):
    from airdata.operators.keys import new_rows_since
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    p = plan(new_rows_since(o, o.filter("o_orderkey < 50"), "o_orderkey"))
    assert "NestedLoop" not in p and any("PushedFilters" in x and "GreaterThan" in x or "ScalarSubquery" in x or "Subquery" in x for x in p.splitlines())


def test_no_nested_loops_in_reports(spark, sf_dir, q):
    for name in ("fk_orphans_cte", "pk_fk_issue_list", "constraint_report", "bts_coverage"):
        p = plan(q[name](spark, sf_dir))
        assert not any(x in p for x in ("NestedLoop", "Cartesian", "to_json")), name
    assert "Expand" not in p   # of the coverage: rows are not multiplied


def test_order_statistics_share_one_plan(spark, sf_dir, q):
    import re
    for name in ("clv_describe", "top_share", "bookings_per_passenger", "top_loyalty_5pct", "get_top_customers"):
        exchanges = re.findall(r"^\(\d+\) (?:Broadcast)?Exchange", plan(q[name](spark, sf_dir)), re.M)
        assert len(exchanges) <= 12, (name, len(exchanges))
