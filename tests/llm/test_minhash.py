import numpy as np

from airdata.llm import minhash as M


def shingle_set(text, k):
    w = [] if text is None else text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, percent):
    """component of each id, from all pairs."""
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    at = {i: i for i, _ in sets if i is not None}

    def find(i):
        while at[i] != i:
            i = at[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, x), (j, y) = sets[a], sets[b]
            if i is not None and j is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(i), find(j)))
                at[q] = p
    return {i: find(i) for i in at}, [(i, len(x)) for i, x in sets]


def test_equals_all_pairs(spark, words):
    rows = []
    for g in range(30):  # groups of edits of one text, chains of edits, unlike texts
        w = words(40 + 5 * g, g)
        for e in range(8):
            v = list(w)
            for x in range(e % 4 * (1 + g % 3)):
                v[(x * 13 + e) % len(v)] = f"edit{g}x{e}x{x}"
            rows.append((1000 - len(rows), " ".join(v)))
            if e % 2:
                w = v
    rows += [(2000 + i, " ".join(words(25, 500 + i))) for i in range(40)] + [(3000, None), (3001, ""), (3002, "a b"), (3003, "A  b"), (3004, "a")]
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    want, sizes = brute(rows, 4, 80)
    assert {r.doc_id: r.component_id for r in found} == want
    assert sorted((r.doc_id, r.n_shingles) for r in found) == sorted(sizes)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_large_group_and_blocks(spark, words, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 16)  # many blocks of one bucket
    w, rows = words(100, 9), []
    for i in range(150):
        v = list(w)
        for x in range(6 if i % 10 == 0 else 1):
            v[(i * 7 + x * 16) % 100] = f"e{i}x{x}"
        rows.append((i, " ".join(v)))
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert {r.doc_id: r.component_id for r in found} == brute(rows, 4, 80)[0]


def test_hard_cases(odd_docs, no_docs):
    found = M.near_duplicates(odd_docs, words=4).collect()
    assert len(found) == odd_docs.count()
    want, _ = brute([(r.doc_id, r.text) for r in odd_docs.collect()], 4, 80)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == want
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    assert M.near_duplicates(no_docs).count() == 0


def test_estimates(spark, words):
    rng = np.random.default_rng(1)
    for j in (0.3, 0.8, 0.95):
        pool = rng.integers(0, 2**64, 3000, dtype=np.uint64)
        n = int(1000 * (1 + j) / 2)
        a, b = np.unique(pool[:n]), np.unique(pool[n - int(2 * n * j / (1 + j)):2 * n - int(2 * n * j / (1 + j))])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        (_, x), (_, y) = M.sketch(a), M.sketch(b)
        row = spark.createDataFrame([(x.tolist(), y.tolist())], "a array<long>, b array<long>")
        from pyspark.sql import functions as F
        got = row.select(M.similarity(M.matches(F.col("a"), F.col("b")))).first()[0]
        assert abs(got - true) < 0.2
        fine = [np.frombuffer(M.fine_sketch(s), np.uint64)[None] for s in (a, b)]
        ok = M.fine_similar(*fine, np.array([len(a)]), np.array([len(b)]), 80)[0]
        assert ok == (true > 0.7)


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(70, 71)]
    got = {r.node: r.component for r in M.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in range(5, 40)} | {70: 70, 71: 70}


def test_large_group_around_an_untypical_smallest_id(spark, words, monkeypatch):
    # copies of one text, each with words of its own changed: linked with the original alone, which has the largest id
    made = []
    real = M._across

    def counted(members, *a):
        got = real(members, *a).cache()
        made.append((members.select("rep").distinct().count(), got.count()))
        return got

    monkeypatch.setattr(M, "_across", counted)
    w, rows = words(300, 21), []
    for i in range(300):
        v = list(w)
        for x in range(9 if i == 0 else 5):  # the smallest id is the farthest
            v[(i * 11 + x * 59) % 300] = f"own{i}x{x}"
        rows.append((i, " ".join(v)))
    rows.append((1000, " ".join(w)))
    found = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert {r.doc_id: r.component_id for r in found} == brute(rows, 4, 80)[0] and {r.component_id for r in found} == {0}
    assert made[0][1] <= max(1, made[0][0]) * 2


def test_block_puts_out_a_spanning_forest(spark, words, monkeypatch):
    # two hundred members of one bucket, none in a component yet: fewer links than members come out, and they connect
    w, rows = words(200, 5), []
    for i in range(200):
        v = list(w)
        v[i] = f"x{i}"
        rows.append((i, " ".join(v)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    s = M.sketches(d, 4).join(d, "doc_id")
    for blocks in (1, 3):
        members = s.selectExpr("1L as key", "doc_id as rep", "doc_id as component", "n_shingles as n", "bits", "fine", "text", f"{blocks} as blocks")
        links = M._across(members, M.floor_of(80), 4, 80).collect()
        assert 199 <= len(links) <= 200 * blocks * 2
        got = {r.component for r in M.components(spark.createDataFrame([(r.u, r.v) for r in links], "u long, v long")).collect()}
        assert got == {0}
