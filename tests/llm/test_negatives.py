import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airdata.llm import negatives as N


def brute(rows, modulo):
    """All rows by plain integers."""
    ok = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        r = (label, [math.floor(256 * x) for x in v])
        ok[i] = min(ok.get(i, r), r)
    out = set()
    for a, (label, q) in ok.items():
        if a % modulo:
            continue
        score = {i: sum(x * y for x, y in zip(v, q)) for i, (_, v) in ok.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if ok[i][0] == label][:5]:
            near = [i for i in order if ok[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]][:5]
            out |= {(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(near)}
    return out


def run(spark, rows, modulo):
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for i, c in enumerate(("key", "score", "bucket", "part", "rank", "norm")):
        d = d.selectExpr("*", f"{i} as {c}")
    got = [tuple(r) for r in N.hard_negatives(d, F.col("key") % modulo == 0).collect()]
    assert len(got) == len(set(got))
    return set(got)


def table(n, d, seed, labels=4, hot=0.0, spread=1.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, d))
    label = r.integers(0, labels, n)
    x = (centres[label] * 0.3 + r.normal(size=(n, d)) * 0.2) * np.exp(r.normal(size=n) * spread)[:, None]
    label = np.where(r.random(n) < hot, 0, label)
    return [(int(i), [float(v) for v in row], int(c)) for i, row, c in zip(r.permutation(n), x, label)]


@pytest.mark.parametrize("hot, spread", [(0.0, 0.0), (0.6, 1.0)])
def test_equals_brute_force(spark, monkeypatch, hot, spread):
    monkeypatch.setattr(N, "BUCKET", 40)  # many buckets, some of several labels, and anchors in turns
    monkeypatch.setattr(N, "ASKING", 7)
    rows = table(700, 12, 3, hot=hot, spread=spread)
    want = brute(rows, 20)
    assert len(want) > 100 and run(spark, rows, 20) == want


def test_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(N, "BUCKET", 30)
    rows = table(300, 6, 5)
    rows = [(i, rows[0][1] if i % 3 else v, i % 4) for i, v, _ in rows]  # a very common vector in all labels
    assert run(spark, rows, 25) == brute(rows, 25)


def test_hard_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (10, [0.0, 0.0], 1), (20, None, 1), (30, [], 2), (40, [1.0, None], 1), (50, [nan, 1.0], 1), (60, [inf, 1.0], 1),
            (70, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (1, [1.0, 2.5], None), (2, [3.0, 1.0], 1), (2, [3.0, 1.5], 0), (3, [-1.0, -2.0], 2), (4, [1.0, 1.9], 2), (5, [0.9, 2.0], 3)]
    assert run(spark, rows, 10) == brute(rows, 10)
    assert run(spark, [], 10) == set() and run(spark, [r for r in rows if r[0] in (3, 4)], 10) == set()
    assert run(spark, [(0, [1.0], 1), (1, [2.0], 2)], 10) == set()  # no positive


def test_scores_beyond_doubles(spark):
    rows = [(i, [2.0**22 + i % 5, float(3 * i + 1)], i % 2) for i in range(20)]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_pruning_keeps_what_scores_enough_and_little_else():
    r = np.random.default_rng(1)
    x = r.normal(size=(4000, 8))
    x = np.floor(2560 * x / np.sqrt((x * x).sum(1))[:, None])  # of like length, as in a bucket
    b = N.Bucket(np.arange(4000), np.zeros(4000, int), x)
    for q in x[:20]:
        s = x @ q
        least = int(np.sort(s)[-20])
        found = b.candidates(q, float(np.sqrt((q * q).sum())), least)
        assert set(np.flatnonzero(s >= least)) <= set(found) and len(found) < 1500
