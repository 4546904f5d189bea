"""Every registered query against its DuckDB oracle (the driver's gate),
at the scale in AIRDATA_TEST_SF (default sf0.001)."""

import pytest

import __spark_entry__ as E
from airdata.plans import catalog
from tests.compare import compare_query, duck

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare_query(spark, sf_dir, QUERIES[name], ORACLE.get(name), con)
    assert ok, f"{name}: {msg}"


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert not missing, missing


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["airport_id", "airport_name", "airport_iata", "total_departures",
                          "total_arrivals", "total_movements"]
