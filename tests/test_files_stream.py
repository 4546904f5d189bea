"""Raw-file readers, loaders, sinks and the incremental stream on small CSVs
written by the test."""

import os

import pytest
from pyspark.sql import functions as F

from airdata.operators import constraints as V
from airdata.operators import maintain as M
from airdata.schema import ForeignKey
from airdata.sources import files as S
from airdata.sources import sinks as W
from airdata.streaming.incremental import stream_bts_folder


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


AIRPORTS = """1,"Goroka Airport","Goroka","Papua New Guinea","GKA","AYGA",-6.08,145.39,5282,10,"U","Pacific/Port_Moresby","airport","OurAirports"
2,"No Codes","X","Y",\\N,\\N,1,2,3,4,"U",\\N,"airport","x"
3,"Dup IATA","X","Y","gka","abcde",bad,2,3,4,"U",\\N,"airport","x"
4,"  Padded  ","X","Y"," lax ",NA,100.5,2,3,-7,"U",,"airport","x"
"""

AIRLINES = """1,"Alpha",\\N,"AA","AAL","A","United States","Y"
2,"Beta",\\N,"AA","BBB","B","Germany","Y"
3,"Gamma",\\N,"CC","AAL","C","France","Y"
4,"Delta",\\N,"CC","DDD","D","Spain","Y"
5,,\\N,"EE","EEE","E","Italy","Y"
"""


def test_openflights_airports(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "airports.dat"), AIRPORTS)
    cand = S.read_openflights_airports(spark, p)
    rows = {r.name: r for r in cand.collect()}
    assert "No Codes" not in rows
    assert rows["Dup IATA"].iata_code == "GKA" and rows["Dup IATA"].icao_code == "ABCD"
    assert rows["Dup IATA"].latitude is None
    assert rows["Padded"].iata_code == "LAX" and rows["Padded"].icao_code is None
    assert rows["Padded"].timezone == "-7"
    empty = spark.createDataFrame([], "iata_code string")
    ins = S.load_airports(empty, cand)
    assert sorted(r.name for r in ins.collect()) == ["Goroka Airport", "Padded"]


def test_openflights_airlines_any_unique(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "airlines.dat"), AIRLINES)
    cand = S.read_openflights_airlines(spark, p)
    assert cand.count() == 4
    empty = spark.createDataFrame([], "iata_code string, icao_code string")
    got = sorted(r.name for r in S.load_airlines(empty, cand).collect())
    # Beta clashes with Alpha on AA; Gamma with Alpha on AAL; Delta is then free on CC.
    assert got == ["Alpha", "Delta"]


BTS_OLD = """year,month,carrier,carrier_name,airport,airport_name,arr_flights,arr_del15,arr_cancelled,arr_diverted,arr_delay,carrier_delay,weather_delay,nas_delay,security_delay,late_aircraft_delay
2024,3,AA,American,JFK,Kennedy,100,10,1,0,500,,1,2,3,4
2024,3,AA,American,JFK,Kennedy,90,9,1,0,400,1,1,2,3,4
2024,12,DL,Delta,ZZZ,Nowhere,5,1,0,0,,1,1,1,1,1
"""


def test_bts_aggregate_and_performance_load(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "bts.csv"), BTS_OLD)
    agg = S.read_bts_aggregate(spark, p)
    r = agg.orderBy("month").first()
    assert r.snapshot_id == "2024_03_AA_JFK" and r.carrier_delay in (0.0, 1.0)
    norm = S.normalise_bts(S.read_csv_header(spark, p))
    assert sorted(x.snapshot_id for x in norm.collect())[0] == "2024-03-AA-JFK"
    airports = spark.createDataFrame([("JFK",)], "iata_code string")
    target = spark.createDataFrame([], "snapshot_id string")
    ins, bad = S.load_bts_performance(target, norm, airports)
    assert ins.count() == 1 and bad.count() == 1
    with pytest.raises(KeyError):
        S.rename_variant_schema(spark.createDataFrame([(1,)], "foo int"))


BTS_FLIGHTS = """MKT_UNIQUE_CARRIER,OP_UNIQUE_CARRIER,MKT_CARRIER_FL_NUM,FL_DATE,ORIGIN,DEST,CRS_DEP_TIME_UTC,CRS_ARR_TIME_UTC,DEP_TIME_UTC,ARR_TIME_UTC,ARR_DELAY,CANCELLED
AA,,100,2024-01-05,JFK,LAX,2024-01-05 10:00:00,2024-01-05 16:00:00,2024-01-05 10:05:00,2024-01-05 16:10:00,10,0
,DL,200,2024-01-06,JFK,LAX,bad,,,,,1
ZZ,,300,2024-01-07,JFK,LAX,,,,,,
"""


def test_bts_flights(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "flights.csv"), BTS_FLIGHTS)
    rows = S.read_bts_flights(spark, p)
    got = {r.flight_number: r for r in rows.collect()}
    assert got["100"].status == "Arrived" and got["200"].status == "Cancelled"
    assert got["300"].status == "Scheduled" and got["200"].airline_code == "DL"
    assert got["200"].sched_dep_utc is None
    airlines = spark.createDataFrame([(1, "AA"), (2, "DL")], "airline_id bigint, iata_code string")
    airports = spark.createDataFrame([(10, "JFK"), (11, "LAX")], "airport_id bigint, iata_code string")
    target = spark.createDataFrame([(2, "200", None)], "airline_id bigint, flight_number string, flight_date date")
    target = target.withColumn("flight_date", F.lit("2024-01-06").cast("date"))
    ins, bad = S.load_bts_flights(target, rows, airlines, airports)
    assert [r.flight_number for r in ins.collect()] == ["100"]
    assert [r.reason for r in bad.collect()] == ["unknown airline"]


def test_seed_if_empty_and_fleet(spark):
    fleet = M.seed_fleet(spark)
    assert [r.aircraft_id for r in fleet.orderBy("aircraft_id").collect()] == [1, 2, 3, 4, 5]
    again = M.seed_fleet(spark, fleet)
    assert again.count() == 5


def test_empty_pool_and_fk_actions(spark):
    df = spark.createDataFrame([(1, None), (2, 7)], "flight_id bigint, aircraft_id bigint")
    out = M.assign_from_pool(df, spark.createDataFrame([], "aircraft_id bigint"))
    assert sorted((r.flight_id, r.aircraft_id) for r in out.collect()) == [(1, None), (2, 7)]
    keyless = M.assign_from_pool(spark.createDataFrame([(None, None), (3, None)], "flight_id bigint, aircraft_id bigint"), spark.createDataFrame([(9,), (9,), (None,)], "aircraft_id bigint"))
    assert sorted(((r.flight_id, r.aircraft_id) for r in keyless.collect()), key=str) == [(3, 9), (None, None)]
    parent_gone = spark.createDataFrame([(1,)], "pid bigint")
    child = spark.createDataFrame([(10, 1), (11, 2), (12, None)], "cid bigint, pid bigint")
    casc = V.apply_fk_action(parent_gone, child, ForeignKey("c", ("pid",), "p", ("pid",), "x", "CASCADE"))
    assert sorted(r.cid for r in casc.collect()) == [11, 12]
    setn = V.apply_fk_action(parent_gone, child, ForeignKey("c", ("pid",), "p", ("pid",), "x", "SET NULL"))
    assert sorted((r.cid, r.pid) for r in setn.collect() if r.pid is not None) == [(11, 2)]
    assert V.restrict_violations(parent_gone, child,
                                 ForeignKey("c", ("pid",), "p", ("pid",), "x", "RESTRICT")).count() == 1
    with pytest.raises(ValueError):
        V.require_non_empty(child.limit(0), "child")


def test_a_changed_pool_moves_few_flights(spark):
    flights = spark.range(4000).select(F.col("id").alias("flight_id"))
    pool = spark.range(1, 41).select(F.col("id").alias("aircraft_id"))
    one = {r.flight_id: r.aircraft_id for r in M.assign_from_pool(flights, pool).collect()}
    two = {r.flight_id: r.aircraft_id for r in M.assign_from_pool(flights, pool.filter("aircraft_id <> 7")).collect()}
    assert len(one) == 4000 and all(two[f] == a for f, a in one.items() if a != 7) and 7 not in two.values()
    share = [list(one.values()).count(a) for a in range(1, 41)]
    assert min(share) > 40 and max(share) < 200   # about a hundred each


def test_incremental_stream_is_idempotent(spark, tmp_dir):
    inbox, target, rejects = (os.path.join(tmp_dir, d) for d in ("inbox", "fp", "q"))
    write(os.path.join(inbox, "part1.csv"), BTS_OLD)
    airports = spark.createDataFrame([("JFK",), ("LAX",)], "iata_code string")

    def run():
        stream_bts_folder(spark, inbox, target, airports, rejects, query_name="t1", checkpoint=os.path.join(tmp_dir, "ckpt"))
        return sorted(r.snapshot_id for r in W.read_table(spark, target).collect())

    assert run() == ["2024-03-AA-JFK"]
    more = BTS_OLD.splitlines()[0] + "\n2024,4,AA,American,LAX,LA,7,1,0,0,9,1,1,1,1,1\n" \
        + "2024,3,AA,American,JFK,Kennedy,1,1,1,1,1,1,1,1,1,1\n"
    write(os.path.join(inbox, "part2.csv"), more)
    assert run() == ["2024-03-AA-JFK", "2024-04-AA-LAX"] == run()
    assert [r.reason for r in W.read_table(spark, rejects).collect()] == ["unknown airport"]
    # a batch that is replayed (its progress lost) changes nothing
    before = W.manifest(spark, target)
    stream_bts_folder(spark, inbox, target, airports, rejects, query_name="t1", checkpoint=os.path.join(tmp_dir, "ckpt2"))
    assert W.read_table(spark, target).count() == 2 and set(before.keys) <= set(W.manifest(spark, target).keys)


CANONICAL = ",".join(S.BTS_CANONICAL)
REORDERED = ",".join(reversed(S.BTS_CANONICAL))


def mixed(folder):
    """A folder of old, canonical and reordered columns, one of an unknown layout, and lines that do not fit."""
    write(os.path.join(folder, "a_old.csv"), BTS_OLD + '2024,5,AA,"broken,JFK,Kennedy,1,1,1,1,1,1,1,1,1,1\n2024,6,AA,x,JFK,y,1\n')
    write(os.path.join(folder, "b_new.csv"), CANONICAL + "\n2023,5,DL,JFK,4,1,0,0,9,1,1,1,1,1\n2023,6,DL,JFK,4,1,0,0,9,1,1,1,1,1,77\n")
    write(os.path.join(folder, "sub", "c_reordered.csv"), REORDERED.upper().replace(",", " ,") + "\n1,1,1,1,1,9,0,0,1,8,LAX,DL,7,2023\n")
    write(os.path.join(folder, "d_odd.csv"), "what,ever\n1,2\n3,4\n")
    write(os.path.join(folder, "e_empty.csv"), "")
    return folder


def test_folder_of_mixed_layouts(spark, tmp_dir):
    rows, rejects = S.read_monthly(spark, mixed(os.path.join(tmp_dir, "in")))
    got = sorted((r.snapshot_id, r.arrivals, r.total_arrival_delay_min) for r in rows.collect())
    assert got == [("2023-05-DL-JFK", 4, 9.0), ("2023-07-DL-LAX", 8, 9.0), ("2024-03-AA-JFK", 90, 400.0), ("2024-03-AA-JFK", 100, 500.0), ("2024-12-DL-ZZZ", 5, 0.0)]
    bad = sorted((os.path.basename(r.file), r.reason, r.line[:8]) for r in rejects.collect())
    assert bad == [("a_old.csv", "broken quotes", '2024,5,A'), ("a_old.csv", "short row", "2024,6,A"), ("b_new.csv", "extra fields", "2023,6,D"),
                   ("d_odd.csv", "unknown layout", "1,2"), ("d_odd.csv", "unknown layout", "3,4")]


def test_every_monthly_line_is_somewhere(spark, tmp_dir):
    folder = mixed(os.path.join(tmp_dir, "in"))
    airports = spark.createDataFrame([("JFK",), ("LAX",)], "iata_code string")
    target = spark.createDataFrame([("2023-05-DL-JFK",)], "snapshot_id string")
    done = S.load_monthly(spark, folder, target, airports)
    assert sorted(r.snapshot_id for r in done.insert.collect()) == ["2023-07-DL-LAX", "2024-03-AA-JFK"]
    assert sorted(r.snapshot_id for r in done.duplicates.collect()) == ["2023-05-DL-JFK", "2024-03-AA-JFK"]
    assert sorted(r.reason for r in done.rejects.collect()) == ["broken quotes", "extra fields", "short row", "unknown airport", "unknown layout", "unknown layout"]


def test_stream_reads_each_file_by_its_header(spark, tmp_dir):
    inbox = os.path.join(tmp_dir, "in")
    write(os.path.join(inbox, "a.csv"), BTS_OLD)
    write(os.path.join(inbox, "b.csv"), REORDERED + "\n1,1,1,1,1,9,0,0,1,8,LAX,DL,7,2023\n")
    airports = spark.createDataFrame([("JFK",), ("LAX",)], "iata_code string")
    stream_bts_folder(spark, inbox, os.path.join(tmp_dir, "fp"), airports, os.path.join(tmp_dir, "q"), query_name="mixed", checkpoint=os.path.join(tmp_dir, "c"))
    got = sorted((r.snapshot_id, r.year) for r in W.read_table(spark, os.path.join(tmp_dir, "fp")).collect())
    assert got == [("2023-07-DL-LAX", 2023), ("2024-03-AA-JFK", 2024)]


def test_one_header_for_all_files_is_an_error(spark, tmp_dir):
    write(os.path.join(tmp_dir, "in", "a.csv"), BTS_OLD)
    write(os.path.join(tmp_dir, "in", "b.csv"), REORDERED + "\n1,1,1,1,1,9,0,0,1,8,LAX,DL,7,2023\n")
    with pytest.raises(Exception, match="CSV header"):
        S.normalise_bts(S.read_csv_header(spark, os.path.join(tmp_dir, "in"))).collect()


def test_every_airport_and_airline_line_is_somewhere(spark, tmp_dir):
    text = AIRPORTS + '5,"Short","X"\n6,"Broken,"X","Y","AAA","AAAA",1,2,3,4,"U",Z,"airport","x"\n7,Extra,X,Y,BBB,BBBB,1,2,3,4,U,Z,airport,x,more,fields\n'
    done = S.load_airports_file(spark, write(os.path.join(tmp_dir, "a.dat"), text), spark.createDataFrame([("LAX",)], "iata_code string"))
    assert sorted(r.name for r in done.insert.collect()) == ["Goroka Airport"]
    assert sorted(r.name for r in done.duplicates.collect()) == ["Dup IATA", "Padded"]
    reasons = sorted(r.reason for r in done.rejects.collect())
    assert len(reasons) == 4 and {"no code", "short row", "extra fields"} <= set(reasons)
    empty = spark.createDataFrame([], "iata_code string, icao_code string")
    done = S.load_airlines_file(spark, write(os.path.join(tmp_dir, "l.dat"), AIRLINES + "6,Short\n"), empty)
    assert [len(d.collect()) for d in done] == [2, 2, 2]
    assert sorted(r.reason for r in done.rejects.collect()) == ["no name", "short row"]


def test_flight_files_of_other_headers(spark, tmp_dir):
    write(os.path.join(tmp_dir, "in", "a.csv"), BTS_FLIGHTS)
    write(os.path.join(tmp_dir, "in", "b.csv"), "dest,origin,fl_date,op_unique_carrier,mkt_carrier_fl_num\nLAX,JFK,2024-02-01,DL,9\nLAX,JFK\n")
    write(os.path.join(tmp_dir, "in", "c.csv"), "origin,dest\nJFK,LAX\n")
    rows, rejects = S.read_flight_files(spark, os.path.join(tmp_dir, "in"))
    got = {r.flight_number: (r.airline_code, r.origin_iata, r.dest_iata, str(r.flight_date)) for r in rows.collect()}
    assert set(got) == {"100", "200", "300", "9"} and got["9"] == ("DL", "JFK", "LAX", "2024-02-01")
    assert sorted(r.reason for r in rejects.collect()) == ["short row", "unknown layout"]


def test_doubled_quotes_stay_in_their_field(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "a.dat"), '1,"Foo ""Bar"" Intl, West",City,Land,FOO,KFOO,1.5,2.5,0,1,E,Zone,airport,x\n')
    r = S.read_openflights_airports(spark, p).first()
    assert (r["name"], r.iata_code, float(r.latitude)) == ('Foo "Bar" Intl, West', "FOO", 1.5)


def test_first_row_in_file_order_wins(spark, tmp_dir):
    line = "1,{name},City,Land,FOO,KFOO,1.5,2.5,0,1,E,Zone,airport,x\n"
    write(os.path.join(tmp_dir, "in", "part1.csv"), line.format(name="First"))
    write(os.path.join(tmp_dir, "in", "part2.csv"), line.format(name="Second") + "".join(
        f"{i},Filler{i},City,Land,,F{i:03d},1,2,0,1,E,Zone,airport,x\n" for i in range(400)))
    rows = S.read_openflights_airports(spark, os.path.join(tmp_dir, "in"))
    empty = spark.createDataFrame([], "iata_code string")
    got = S.load_airports(empty, rows).filter("iata_code = 'FOO'").collect()
    assert [r["name"] for r in got] == ["First"]
    head = BTS_OLD.splitlines()[0]
    p = write(os.path.join(tmp_dir, "m.csv"), head + "\n2024,3,AA,x,JFK,y,500,1,1,1,1,1,1,1,1,1\n2024,3,AA,x,JFK,y,100,1,1,1,1,1,1,1,1,1\n")
    target = spark.createDataFrame([], "snapshot_id string")
    ins, _ = S.load_bts_performance(target, S.normalise_bts(S.read_csv_header(spark, p, order=True)),
                                    spark.createDataFrame([("JFK",)], "iata_code string"))
    assert [r.arrivals for r in ins.collect()] == [500]


def test_bad_numbers_missing_keys_and_unknown_airlines(spark, tmp_dir):
    head = BTS_OLD.splitlines()[0]
    p = write(os.path.join(tmp_dir, "m.csv"), head + "\n2024,1,AA,x,JFK,y,NaN,2.6,1,1,NaN,1,1,1,1,1\n"
              ",1,AA,x,JFK,y,1,1,1,1,1,1,1,1,1,1\n2024,2,QQ,x,JFK,y,1,1,1,1,1,1,1,1,1,1\n")
    norm = S.normalise_bts(S.read_csv_header(spark, p, order=True))
    airports, airlines = spark.createDataFrame([("JFK",)], "iata_code string"), spark.createDataFrame([("AA",)], "iata_code string")
    ins, bad = S.load_bts_performance(spark.createDataFrame([], "snapshot_id string"), norm, airports, airlines)
    assert [(r.snapshot_id, r.arrivals, r.arrivals_delayed_15min, r.total_arrival_delay_min) for r in ins.collect()] == [("2024-01-AA-JFK", 0, 3, 0.0)]
    assert sorted(r.reason for r in bad.collect()) == ["missing key part", "unknown airline"]


def test_us_dates_and_rows_without_key(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "f.csv"), BTS_FLIGHTS.splitlines()[0] + "\nAA,,7,1/9/2024 12:00:00 AM,JFK,LAX,,,,,,0\nAA,,8,someday,JFK,LAX,,,,,,0\n")
    rows = S.read_bts_flights(spark, p)
    airlines = spark.createDataFrame([(1, "AA")], "airline_id bigint, iata_code string")
    airports = spark.createDataFrame([(10, "JFK"), (11, "LAX")], "airport_id bigint, iata_code string")
    empty = spark.createDataFrame([], "airline_id bigint, flight_number string, flight_date date")
    ins, bad = S.load_bts_flights(empty, rows, airlines, airports)
    assert [(r.flight_number, str(r.flight_date)) for r in ins.collect()] == [("7", "2024-01-09")]
    assert [(r.flight_number, r.reason) for r in bad.collect()] == [("8", "missing key part")]


def test_codes_never_repeat(spark):
    from airdata.sources.fixtures import _pad
    df = spark.createDataFrame([(1000,), (10000,), (10009,), (7,)], "k long")
    assert [r.c for r in df.select(_pad(F.col("k"), 4).alias("c")).collect()] == ["1000", "10000", "10009", "0007"]


def test_any_unique_with_equal_order_values(spark):
    from airdata.operators.keys import insert_ignore_any_unique
    c = spark.createDataFrame([(1, "a", "x"), (1, "a", "y"), (1, None, "y")], "o int, k string, m string")
    got = insert_ignore_any_unique(c.limit(0), c, ["k", "m"], "o").collect()
    assert len([r for r in got if r.k == "a"]) == 1


def test_checkpoint_folder_must_be_shared(monkeypatch):
    from airdata.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
