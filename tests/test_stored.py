"""Steps that several readers share are computed once and stored; the results are those of the plain formulas."""

import contextlib
import io
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from airdata import schema as S
from airdata.operators import constraints as V
from airdata.operators.keys import number_rows
from airdata.operators.reports import clv_lorenz
from airdata.sources import files
from airdata.sources.fixtures import Fixtures
from airdata.sources.tables import written


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode="formatted")
    return text.getvalue()


def only_stored(df, root):
    return bool(df.inputFiles()) and all(root.split(":")[-1] in f for f in df.inputFiles())


def test_stored_numbers_are_row_numbers(spark):
    r = random.Random(5)
    keys = list({(r.choice([None, *range(-40, 40)]), r.choice([None, *range(60)])) for _ in range(3000)})
    rows = spark.createDataFrame([(*k, str(k)) for k in keys], "a long, b int, t string").repartition(13)
    got = number_rows(written(rows, "rows"), ["a", "b"], "id", "numbered")
    assert got.columns == ["id", "a", "b", "t"]
    want = rows.select(F.row_number().over(Window.orderBy("a", "b")).cast("bigint").alias("id"), "a", "b", "t")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == len(keys)
    assert number_rows(written(rows.limit(0), "rows"), ["a"], "id", "numbered").count() == 0


def test_derived_tables_are_derived_once(spark, sf_dir):
    fx, root = Fixtures(spark, sf_dir), spark.conf.get("spark.checkpoint.dir")
    for t in (fx.flights_loaded, fx.routes, fx.flights, fx.bookings, fx.payments, fx.clv):
        assert only_stored(t, root)
    assert "booking_id" not in plan(fx.bookings.select("flight_id")).split("ReadSchema")[1].split("\n")[0]


def test_checked_payments_are_the_rows_of_the_view(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    o, p = fx.payments_orphan, fx.payments
    want = o.join(p.select("payment_id", "paid_at", F.when(F.col("payment_id") % 149 == 0, "Barter").otherwise(F.col("method")).alias("method")), "payment_id")
    joins = [plan(d).count("Join") for d in (fx.payments, fx.payments_checked)]   # that of the ids
    assert sorted(want.columns) == sorted(fx.payments_checked.columns) and joins[0] == joins[1]
    want = want.select(*fx.payments_checked.columns)
    assert want.exceptAll(fx.payments_checked).isEmpty() and fx.payments_checked.exceptAll(want).isEmpty()


def test_lorenz_reads_customers_not_payments(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    assert "SortMergeJoin" not in plan(clv_lorenz(fx.clv)) and only_stored(clv_lorenz(fx.clv), spark.conf.get("spark.checkpoint.dir"))


def test_unique_keys_are_not_held_before_the_shuffle(spark):
    rows = [(1, "a"), (1, "b"), (2, "b"), (None, "c"), (None, "c"), (3, None), (4, None)]
    t = {"a": spark.createDataFrame(rows, "id long, s string").repartition(3)}
    report = V.constraint_report(t, uniques=(S.Unique("a", ("id",), "pk"), S.Unique("a", ("s",), "uq"), S.Unique("a", ("id", "s"), "both")))
    assert {(r.check_name, r.violations) for r in report.collect()} == {("pk", 1), ("uq", 2), ("both", 0)}
    assert "REPARTITION_BY_NUM" in plan(report)


def test_monthly_lines_are_read_once(spark, tmp_dir):
    rows = [("1", "L1", "A1", "5"), ("1", "L1", "A1", "6"), ("1", "L1", "A9", "7"), (None, "L1", "A1", "8"), ("2", "L2", "A1", "9"), ("3", "L1", "A1", "1")]
    cols = [c for c in files.BTS_CANONICAL if c not in ("year", "month", "airline_iata", "airport_iata", "arrivals")]
    df = spark.createDataFrame(rows, "month string, airline_iata string, airport_iata string, arrivals string").coalesce(1)
    df.select(F.lit("2024").alias("year"), "*", *[F.lit("1").alias(c) for c in cols]).select(*files.BTS_CANONICAL).write.option("header", True).csv(f"{tmp_dir}/in")
    airports = spark.createDataFrame([("A1",), ("A1",), (None,)], "iata_code string")
    airlines = spark.createDataFrame([("L1",)], "iata_code string")
    done = files.load_monthly(spark, f"{tmp_dir}/in", spark.createDataFrame([("2024-03-L1-A1",), ("2024-03-L1-A1",), (None,)], "snapshot_id string"), airports, airlines)
    assert [r.arrivals for r in done.insert.collect()] == [5]
    assert sorted(r.arrivals for r in done.duplicates.collect()) == [1, 6]
    assert sorted(r.reason for r in done.rejects.collect()) == ["missing key part", "unknown airline", "unknown airport"]
    for d in (done.insert, done.duplicates):
        assert only_stored(d, spark.conf.get("spark.checkpoint.dir"))
