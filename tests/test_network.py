"""Bounded path search: the first paths, by brute force over all of them."""

import random

import pytest

from airdata.operators import network as N


def world(spark, n, routes, seed, codes=None):
    r = random.Random(seed)
    code = {i: (codes or (lambda i: f"A{i:03d}"))(i) for i in range(n)}
    legs = [(a, b) for a, b in ((r.randrange(n), r.randrange(n)) for _ in range(routes)) if a != b]
    legs += [(0, b) for b in range(1, n)]   # the busiest origin
    legs += r.sample(legs, len(legs) // 4)  # parallel routes
    ro = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(legs)], "route_id long, origin_airport_id long, destination_airport_id long")
    ap = spark.createDataFrame(list(code.items()), "airport_id long, iata_code string")
    count = {}
    for a, _ in legs:
        count[a] = count.get(a, 0) + 1
    hub = min(count, key=lambda a: (-count[a], a))
    paths, level = [], [([hub], [code[hub]])]
    for h in (1, 2, 3):
        nxt = []
        for ids, names in level:
            for a, b in legs:
                if a == ids[-1] and (h == 1 or (code[b] is not None and None not in names and code[b] not in names)):
                    nxt.append((ids + [b], names + [code[b]]))
        level = nxt
        paths += [(names[0], names[-1], h, ">".join(x for x in names if x is not None)) for _, names in level]
    return ro, ap, paths


@pytest.mark.parametrize("n, routes, seed, codes", [
    (12, 60, 1, None), (30, 60, 2, None), (40, 10, 3, None),
    (14, 80, 4, lambda i: f"B{i // 2}"),        # two airports a code
    (9, 3, 5, None)])
@pytest.mark.parametrize("limit", [1, 7, 50, 10_000])
def test_first_paths_equal_brute_force(spark, n, routes, seed, codes, limit):
    ro, ap, paths = world(spark, n, routes, seed, codes)
    got = [tuple(r) for r in N.connectivity_3hop(ro, ap, limit).collect()]
    assert got == sorted(set(paths), key=lambda p: (p[2], p[1], p[3]))[:limit]
    got = [tuple(r) for r in N.multihop_paths(ro, ap, limit).collect()]
    assert got == sorted(paths, key=lambda p: (-p[2], p[1], p[3]))[:limit]


def test_only_paths_that_can_be_shown_are_made(spark):
    ro, ap, paths = world(spark, 40, 900, 7)
    deep = sum(p[2] == 3 for p in set(paths))
    made = N.first_paths(ro, ap, 50, deepest_first=True)
    assert made.select("hops").distinct().count() == 1 and made.count() < deep / 20
    made = N.first_paths(ro, ap, 20, deepest_first=False)
    assert {r.hops for r in made.collect()} == {1}


def test_no_routes(spark):
    ro = spark.createDataFrame([], "route_id long, origin_airport_id long, destination_airport_id long")
    ap = spark.createDataFrame([(1, "A")], "airport_id long, iata_code string")
    assert N.connectivity_3hop(ro, ap).count() == 0 and N.multihop_paths(ro, ap).count() == 0
