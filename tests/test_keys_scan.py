"""Keys, fixpoint insert-ignore, distributed prefix sums / ranks / quantiles
against straightforward references on small inputs."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from airdata.operators import keys as K
from airdata.operators.scan import exact_quantiles, prefix_sum, running_sum
from airdata.operators.windows import percent_rank_at_least


def test_surrogate_key_equals_row_number(spark):
    rows = [(random.randint(0, 50), random.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = {(r.a, r.b, r.c): r.id for r in K.assign_surrogate_key(df, ["a", "b", "c"], "id", 7).collect()}
    ref = sorted(rows)
    assert got == {k: i + 7 for i, k in enumerate(ref)}


def test_surrogate_key_after_max(spark):
    existing = spark.createDataFrame([(10,), (42,)], "id bigint")
    new = spark.createDataFrame([("b",), ("a",)], "k string")
    got = sorted((r.k, r.id) for r in K.next_key_after_max(new, existing, "id", ["k"]).collect())
    assert got == [("a", 43), ("b", 44)]
    empty = spark.createDataFrame([], "id bigint")
    got = sorted((r.k, r.id) for r in K.next_key_after_max(new, empty, "id", ["k"]).collect())
    assert got == [("a", 1), ("b", 2)]


def fold(rows, keys):
    used = {k: set() for k in keys}
    out = []
    for r in sorted(rows, key=lambda r: r["ord"]):
        if all(r[k] is None or r[k] not in used[k] for k in keys):
            out.append(r["ord"])
            for k in keys:
                if r[k] is not None:
                    used[k].add(r[k])
    return sorted(out)


def test_any_unique_fixpoint_equals_fold(spark):
    rng = random.Random(7)
    for trial in range(4):
        rows = [{"ord": i, "a": rng.choice([None, *range(8)]), "b": rng.choice([None, *range(8)])}
                for i in range(40)]
        df = spark.createDataFrame([(r["ord"], r["a"], r["b"]) for r in rows], "ord int, a int, b int")
        # also components too large for a task
        got = sorted(r.ord for r in K.insert_ignore_any_unique(df.limit(0), df, ["a", "b"], "ord", fold=3 if trial % 2 else K.FOLD).collect())
        assert got == fold(rows, ["a", "b"]), trial


def test_long_chain_of_conflicts_takes_few_rounds(spark, monkeypatch):
    n, seen = 10_000, []
    rows = [{"ord": i, "a": i // 2, "b": (i + 1) // 2} for i in range(n)]   # each row shares a key with the next
    real = K.connected_components

    def counted(links):
        out, rounds = real(links)
        seen.append(rounds)
        return out, rounds

    monkeypatch.setattr(K, "connected_components", counted)
    df = spark.createDataFrame([(r["ord"], r["a"], r["b"]) for r in rows], "ord int, a int, b int")
    got = sorted(r.ord for r in K.insert_ignore_any_unique(df.limit(0), df, ["a", "b"], "ord").collect())
    assert got == fold(rows, ["a", "b"]) and seen[0] < 20


def test_insert_ignore_null_keys_and_existing(spark):
    target = spark.createDataFrame([("X",)], "k string")
    cand = spark.createDataFrame([(1, "X"), (2, "Y"), (3, "Y"), (4, None), (5, None)], "o int, k string")
    got = sorted((r.o, r.k) for r in K.insert_ignore(target, cand, ["k"], ["o"]).collect())
    assert got == [(2, "Y"), (4, None), (5, None)]


def test_prefix_sum(spark):
    rows = [(i, random.randint(-5, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, v bigint")
    got = {r.k: r.s for r in prefix_sum(df, ["k"], "v", "s").collect()}
    acc, ref = 0, {}
    for k, v in rows:
        acc += v
        ref[k] = acc
    assert got == ref


def test_running_sum_hot_key_matches_window(spark):
    rows = [(0 if i % 3 else i % 7, i, (i * 37) % 11) for i in range(600)]   # key 0 holds 2/3
    df = spark.createDataFrame(rows, "p int, o int, v bigint")
    df = df.withColumn("p", F.when(F.col("p") != 4, F.col("p")))              # and a null group
    got = {(r.p, r.o): r.s for r in running_sum(df, ["p"], ["o"], "v", "s", num_partitions=9).collect()}
    w = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    ref = {(r.p, r.o): r.s for r in df.withColumn("s", F.sum("v").over(w)).collect()}
    assert got == ref


def test_exact_quantiles_match_numpy(spark):
    vals = [random.random() * 100 for _ in range(101)] + [5.0, 5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = exact_quantiles(df, "v", [0.25, 0.5, 0.75]).first()
    ref = np.quantile(vals, [0.25, 0.5, 0.75])
    assert np.allclose([got.q25, got.q50, got.q75], ref)


def test_percent_rank_filter_matches_window(spark):
    rows = [(i, random.choice([0, 0, 0, 1, 2, 3, 5, 8, 13])) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, v int")
    got = {(r.id, round(r.pr, 12)) for r in percent_rank_at_least(df, "v", 0.5, "pr").collect()}
    w = Window.orderBy("v")
    ref = {(r.id, round(r.pr, 12)) for r in
           df.withColumn("pr", F.percent_rank().over(w)).filter("pr >= 0.5").collect()}
    assert got == ref
    single = spark.createDataFrame([(1, 5)], "id int, v int")
    assert [r.pr for r in percent_rank_at_least(single, "v", 0.0, "pr").collect()] == [0.0]


def test_insert_ignore_properties(spark):
    # output keys are unique, a subset of the candidates, and disjoint from the target
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "a", "b", "c", "d"]), rng.randint(0, 3)) for i in range(60)]
    cand = spark.createDataFrame(rows, "o int, k string, v int")
    target = spark.createDataFrame([("c",)], "k string")
    out = [(r.o, r.k, r.v) for r in K.insert_ignore(target, cand, ["k"], ["o"]).collect()]
    keys = [k for _, k, _ in out if k is not None]
    assert len(keys) == len(set(keys)) and "c" not in keys
    assert set(out) <= set(rows)
    assert sum(1 for _, k, _ in out if k is None) == sum(1 for _, k, _ in rows if k is None)
    # the kept row of each key is its first by order
    firsts = {}
    for o, k, v in sorted(rows):
        if k is not None and k != "c":
            firsts.setdefault(k, (o, k, v))
    assert {r for r in out if r[1] is not None} == set(firsts.values())


def test_running_sum_last_value_is_total(spark):
    rows = [(i % 5, i, i % 13 - 4) for i in range(200)]
    df = spark.createDataFrame(rows, "p int, o int, v bigint")
    rs = running_sum(df, ["p"], ["o"], "v", "s", num_partitions=7)
    last = {r.p: r.s for r in rs.groupBy("p").agg(F.max_by("s", "o").alias("s")).collect()}
    totals = {r.p: r.t for r in df.groupBy("p").agg(F.sum("v").alias("t")).collect()}
    assert last == totals


def test_histogram_counts_sum_to_rows(spark):
    from airdata.operators.reports import histogram
    vals = [(None if v is None else float(v),) for v in [0, 1, 1, 2, 5, 9, 9, 10, 10, None]]
    df = spark.createDataFrame(vals, "x double")
    h = histogram(df, "x", 5).collect()
    assert len(h) == 5 and sum(r["count"] for r in h) == 9
    assert h[-1]["count"] == 4     # last bin is closed on the right (9, 9, 10, 10)


def test_ids_are_a_function_of_the_rows(spark):
    # however the rows are dealt and however often the plan runs, ids stay
    rows = [(random.choice([None, "a", "b", "ä"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, v int")
    runs = [{(r.k, r.v): r.id for r in K.assign_surrogate_key(d, ["k", "v"], "id", num_partitions=n).collect()}
            for d, n in ((df, 8), (df.repartition(13), 8), (df, 1), (df, 50))]
    ref = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    assert all(r == {k: i + 1 for i, k in enumerate(ref)} for r in runs)


def test_no_checkpoint_in_ordered_scans(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    monkeypatch.setattr(DataFrame, "checkpoint", None)
    monkeypatch.setattr(DataFrame, "localCheckpoint", None)
    df = spark.range(100).selectExpr("id % 3 as p", "id as o", "id as v")
    assert K.assign_surrogate_key(df, ["o"], "n").count() == 100
    assert running_sum(df, ["p"], ["o"], "v", "s").count() == 100 and prefix_sum(df, ["o"], "v", "s").count() == 100
    assert prefix_sum(df.limit(0), ["o"], "v", "s").count() == 0


def test_running_takes_any_aggregate(spark):
    from airdata.operators.scan import running
    rows = [(None if i % 2 else 1, i, None if i % 5 == 0 else (i * 7919) % 1009) for i in range(300)]
    df = spark.createDataFrame(rows, "p int, o int, v bigint")
    got = running(df, ["p"], ["o"], {"x": (F.col("v"), F.bit_xor, lambda a, b: a.bitwiseXOR(b)), "m": (F.col("v"), F.max, F.greatest)}, num_partitions=11)
    w = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("x", F.bit_xor("v").over(w)).withColumn("m", F.max("v").over(w))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)


def test_order_statistics_hold_with_any_cut_points(spark):
    from airdata.operators.scan import order_statistics, value_counts
    vals = [random.choice([-5, 0, 0, 3, 3, 3, 8, 100, None]) for _ in range(400)] + list(range(200, 300))
    counts = value_counts(spark.createDataFrame([(v,) for v in vals], "v int"), "v")
    ref = sorted(v for v in vals if v is not None)
    at = [0, 1, 17, len(ref) // 2, len(ref) - 1]
    ranks = {f"r{i}": F.lit(i) for i in at} | {"last": F.col("_n") - 1, "off": F.col("_n"), "neg": F.lit(-1)}
    for bounds in (None, [], [-1000], [1000], [3, 3, 3], [-7, 250, 251]):   # also none, all on one side, repeated
        got = order_statistics(counts, ranks, bounds, below=True).first()
        assert [got[f"r{i}"] for i in at] == [ref[i] for i in at] and got["last"] == ref[-1], bounds
        assert [got[f"r{i}_below"] for i in at] == [sum(v < ref[i] for v in ref) for i in at]
        assert got["off"] is None and got["neg"] is None
    assert order_statistics(counts.limit(0), {"x": F.lit(0)}).first().x is None


def test_quantiles_of_hot_and_few_values(spark):
    for vals in ([7.0], [1.0, 2.0], [5.0] * 900 + [6.0] * 3, []):
        df = spark.createDataFrame([(v,) for v in vals], "v double")
        got = exact_quantiles(df, "v", [0.25, 0.5, 0.75]).first()
        want = np.quantile(vals, [0.25, 0.5, 0.75]) if vals else [None] * 3
        assert list(got) == list(want)
