import random
from collections import Counter

import pytest

from airdata.llm import mixing as M


def brute_targets(sizes):
    """The weights in turn, and sharing again until nothing is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not above:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: 3 * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 100, "b": 1, "c": 50, None: 3}, {"a": 1, "b": 1, "c": 1000}, {"x": 0, "y": 5}, {"é": 7, "z": 9, "": 4, "Z": 2}])
def test_targets(spark, sizes):
    got = M.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = brute_targets(sizes)
    assert {r.source: r.target for r in got} == pytest.approx(want)


def test_walk_keeps_the_totals():
    r = random.Random(5)
    for _ in range(50):
        n = r.randint(1, 60)
        size, pi, draw = [r.randint(0, 50) for _ in range(n)], [r.random()] * n, [r.random() for _ in range(n)]
        end = M.walk(size, pi, draw)
        assert sum(0 < p < 1 for p in end) <= 2 and all(0 <= p <= 1 for p in end)
        assert sum(end) == pytest.approx(sum(pi), abs=1e-6) and sum(a * b for a, b in zip(size, end)) == pytest.approx(sum(a * b for a, b in zip(size, pi)), abs=1e-4)


def test_walk_keeps_the_probabilities():
    r, size, pi, n = random.Random(6), [1, 2, 3, 5, 8, 13], [0.3, 0.3, 0.5, 0.7, 0.5, 0.7], 20_000
    mean = [0.0] * 6
    for _ in range(n):
        for k, p in enumerate(M.walk(size, pi, [r.random() for _ in size])):
            mean[k] += p / n
    assert mean == pytest.approx(pi, abs=0.02)


def test_mix(spark):
    r = random.Random(1)
    rows = [(i, " ".join(["w"] * int(r.lognormvariate(4, 1))), "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(3000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix(d, block=100).collect()
    assert sorted(g.doc_id for g in got) == list(range(3000)) and max(g.copies for g in got) <= 3
    taken, want = Counter(), {}
    for g in got:
        taken[g.source] += g.copies * g.size
        want[g.source] = g.target
        assert g.copies in (int(g.rate), int(g.rate) + 1)
    largest = {}
    for g in got:
        largest[g.source] = max(g.size, largest.get(g.source, 0))
    for s, t in want.items():  # a large document may be left open to the end
        assert abs(taken[s] - t) <= max(0.01 * t, largest[s] / 2)
    again = M.mix(d.repartition(7), block=100).collect()
    assert {g.doc_id: g.copies for g in got} == {g.doc_id: g.copies for g in again}


def test_hard_cases(spark, odd_docs, no_docs):
    got = M.mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert Counter((g.doc_id, g.size, g.source) for g in got) == Counter((r.doc_id, len((r.text or "").encode().split()), r.source) for r in odd_docs.collect())
    assert M.mix(no_docs).count() == 0 and M.mixed(no_docs).count() == 0
    whole = M.mixed(odd_docs)
    assert whole.columns == odd_docs.columns
    taken = Counter()
    for g in got:
        taken[g.doc_id] += g.copies
    assert Counter(r.doc_id for r in whole.collect()) == Counter({k: v for k, v in taken.items() if v})


@pytest.mark.parametrize("key", ["cast(null as long)", "cast(7 as long)"])
def test_mixed_keeps_the_targets_of_rows_without_own_keys(spark, key):
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * r.randint(5, 60)), "abc"[min(2, i % 5)]) for i in range(600)]
    d = spark.createDataFrame(rows, "n long, text string, source string").selectExpr(f"{key} as doc_id", "*")
    sizes, taken = Counter(), Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    whole = M.mixed(d).collect()
    for x in whole:
        taken[x.source] += len(x.text.split())
    want = brute_targets(sizes)
    assert max(want[s] / sizes[s] for s in want) > 1.5 * min(want[s] / sizes[s] for s in want)
    assert all(abs(taken[s] - t) <= 0.01 * t + 30 for s, t in want.items())
    assert max(Counter(x.n for x in whole).values()) <= M.MOST
