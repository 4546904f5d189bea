import numpy as np
import pytest

from airdata.llm import ann as A


def exact(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    keep = np.arange(len(ids)) != q
    o = np.lexsort((ids[keep], d[keep]))[:k]
    return list(ids[keep][o]), d[keep][o]


def run(spark, ids, x, modulo, k=10, **kw):
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(ids, x)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {}
    for r in A.search(d, d.filter(f"vec_id % {modulo} = 0"), k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def recall(ids, x, got):
    hit = total = 0
    for q, rows in got.items():
        near, _ = exact(ids, x, int(np.flatnonzero(ids == q)[0]))
        hit += len(set(near) & {v for _, v, _ in rows})
        total += len(near)
    return hit / total


@pytest.mark.parametrize("kind", ["even", "clustered"])
def test_recall(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32))
    if kind == "clustered":
        x = x * 0.2 + rng.normal(size=(20, 32))[rng.integers(0, 20, 3000)]
    ids = rng.permutation(3000)
    got = run(spark, ids, x, 100)
    assert len(got) == 30 and recall(ids, x, got) >= 0.9
    for q, rows in got.items():
        assert [r for r, _, _ in rows] == list(range(1, 11)) and q not in {v for _, v, _ in rows}
        for _, v, s in rows:
            assert s == pytest.approx(np.sqrt(((x[ids == q][0] - x[ids == v][0]) ** 2).sum()), rel=1e-12)
        assert [(s, v) for _, v, s in rows] == sorted((s, v) for _, v, s in rows)


def test_driver_table_recall(spark):
    from airdata.llm.queries import op8_permutation_index

    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in op8_permutation_index(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert len(got) == (ids % 100 == 0).sum() and recall(ids, x, got) >= 0.9


def test_few_and_equal_vectors(spark, monkeypatch):
    ids, x = np.arange(7), np.array([[1, 0], [1, 0], [0, 1], [1, 1], [2, 0], [1, 0], [5, 5]], float)
    got = run(spark, ids, x, 1)
    for q, rows in got.items():
        near, d = exact(ids, x, q)
        assert [v for _, v, _ in rows] == near and [s for _, _, s in rows] == pytest.approx(list(d))
    monkeypatch.setattr(A, "BLOCK", 50)  # a very common vector, over many blocks
    x = np.random.default_rng(0).normal(size=(600, 8))
    x[:400] = x[0]
    got = run(spark, np.arange(600), x, 200)
    assert [v for _, v, _ in got[0]] == list(range(1, 11)) and [v for _, v, _ in got[200]] == list(range(10))


def test_hard_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (100, [0.0, 0.0], 1), (200, None, 1), (300, [], 1), (400, [1.0, None], 1), (500, [nan, 1.0], 1), (600, [inf, 1.0], 1), (700, [1.0, 2.0, 3.0], 1),
            (None, [1.0, 1.0], 1), (1, [1.0, 2.5], 1), (2, [3.0, 1.0], 1), (2, [3.0, 1.5], 1)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int").selectExpr("*", "0 as score", "0 as pivot", "0 as key")
    got = A.search(d, d.filter("vec_id % 100 = 0")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert A.search(d.limit(0), d.limit(0)).count() == 0 and A.search(d, d.limit(0)).count() == 0
