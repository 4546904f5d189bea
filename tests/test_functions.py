"""Edge cases of the cleaning expressions."""

from pyspark.sql import functions as F

from airdata.functions import clean as C
from airdata.functions.numeric import pct, round_half_up


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_clean_str(spark):
    assert one(spark, C.clean_str("x"), "  a b \t") == "a b"
    assert one(spark, C.clean_str("x"), "   ") is None
    assert one(spark, C.clean_str("x"), "\\N") is None
    assert one(spark, C.clean_str("x", backslash_n_null=False), "\\N") == "\\N"
    assert one(spark, C.clean_str("x"), None) is None


def test_sentinels_one_pass_and_fixpoint(spark):
    cases = {"": (None, None), " ": (None, None), "NA": (None, None), "\\N": (None, None),
             "  ": ("", None), " na ": ("NA", None), " jfk ": ("JFK", "JFK"), None: (None, None)}
    for raw, (once, fix) in cases.items():
        assert one(spark, C.clean_code("x"), raw) == once, raw
        assert one(spark, C.clean_code("x", fixpoint=True), raw) == fix, raw


def test_fixpoint_is_idempotent(spark):
    for raw in ["", " ", "  ", " na ", "NA", " x ", "\\N", " \\N "]:
        once = one(spark, C.clean_code("x", fixpoint=True), raw)
        twice = one(spark, C.clean_code(C.clean_code("x", fixpoint=True), fixpoint=True), raw)
        assert once == twice


def test_initcap_like_postgres(spark):
    assert one(spark, C.initcap_trim("x"), "  o'brien MARY-ANN 12 ") == "O'Brien Mary-Ann 12"
    assert one(spark, C.initcap_pg("x"), "hello   world") == "Hello   World"
    assert one(spark, C.initcap_pg("x"), "a1b c_d") == "A1b C_D"
    assert one(spark, C.initcap_pg("x"), "") == ""


def test_zfill_never_truncates(spark):
    assert one(spark, C.zfill("x", 4), "12345") == "12345"
    assert one(spark, C.zfill("x", 2), "3") == "03"
    r = spark.createDataFrame([(2024, 3, "AA", "JFK")], "y int, m int, a string, p string")
    assert r.select(C.snapshot_id("y", "m", "a", "p")).first()[0] == "2024-03-AA-JFK"
    assert r.select(C.snapshot_id("y", "m", "a", "p", sep="_")).first()[0] == "2024_03_AA_JFK"


def test_negative_and_clamps(spark):
    assert one(spark, C.negative_to_null("x"), -1, "x int") is None
    assert one(spark, C.negative_to_null("x"), 0, "x int") == 0
    assert one(spark, C.clamp_min("x", 0), -5, "x int") == 0
    assert one(spark, C.clamp_min("x", 0), None, "x int") is None
    assert one(spark, C.clamp("x", 80, 900), 1000, "x int") == 900
    assert one(spark, C.non_positive_to_null("x"), 0, "x int") is None
    assert one(spark, C.fill_numeric_zero("x"), "abc") == 0.0
    assert one(spark, C.fill_numeric_zero("x"), "2.5") == 2.5


def test_age_bucket(spark):
    got = [one(spark, C.age_bucket("x"), v, "x int") for v in [17, 18, 25, 26, 45, 46, 60, 61, 90, None]]
    assert got == ["18-25", "18-25", "18-25", "26-35", "36-45", "46-60", "46-60", "60+", "60+", None]


def test_signed_miles_and_status(spark):
    df = spark.createDataFrame([("REDEEM", 500), ("EARN", -300), ("points_spend", 10), ("ADJUST", 7)],
                               "t string, m int")
    assert [r[0] for r in df.select(C.signed_miles("t", "m")).collect()] == [-500, 300, -10, 7]
    s = spark.createDataFrame([(1.0,), (0.0,), (None,), (5.0,)], "c double")
    assert [r[0] for r in s.select(C.map_status("c")).collect()] == [
        "Cancelled", "Arrived", "Scheduled", "Scheduled"]


def test_actual_times(spark):
    df = spark.createDataFrame(
        [("Cancelled", 30), ("scheduled", 0), ("Arrived", 15), ("Departed", None)],
        "status string, delay int").withColumn(
        "dep", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")).withColumn(
        "arr", F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    dep, arr = C.actual_times("status", "dep", "arr", "delay")
    rows = df.select(dep, arr).collect()
    assert rows[0][0] is None and rows[1][0] is None
    assert str(rows[2][0]) == "2024-01-01 10:15:00" and str(rows[2][1]) == "2024-01-01 12:15:00"
    assert str(rows[3][0]) == "2024-01-01 10:00:00"


def test_round_half_up_through_decimal(spark):
    assert one(spark, round_half_up(F.col("x"), 2), 1.005, "x double") == 1.01
    assert one(spark, round_half_up(F.col("x"), 2), 2.675, "x double") == 2.68
    df = spark.createDataFrame([(1, 8)], "a int, b int")
    assert df.select(pct(F.col("a"), F.col("b"))).first()[0] == 12.5
    df0 = spark.createDataFrame([(1, 0)], "a int, b int")
    assert df0.select(pct(F.col("a"), F.col("b"))).first()[0] is None
