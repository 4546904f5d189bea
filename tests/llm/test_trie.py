import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from airdata.llm import trie as T


def brute(rows):
    """The nodes by plain dictionaries: {(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, sha)}."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:3])] for c, v in convs.items()}
    paths = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, p in sorted(paths.items()):
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    out = {}
    words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in members}
    below = defaultdict(list)
    for p in members:
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    leaf = {p for p in members if len(below[p]) == 1}
    for p, m in members.items():
        sub = below[p]
        ended = ",".join(str(c) for c in m if len(paths[c]) == len(p))
        out[m[0], len(p)] = (members[p[:-1]][0] if p else None, len(m), sum(len(q) == len(p) + 1 for q in sub), sum(q in leaf for q in sub),
                             sum((len(members[q]) - 1) * words[q] for q in sub), hashlib.sha256(ended.encode()).hexdigest())
    return out


def run(spark, rows, **kw):
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for i, c in enumerate(("depth", "node", "weight", "a", "top", "n", "pos")):
        d = d.selectExpr("*", f"{i} as {c}")
    got = T.prefix_trie(d, **kw).collect()
    assert len({(r.conv_id, r.depth) for r in got}) == len(got)
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}


def talk(n, seed, hot=0.4):
    """n conversations; many share first turns, some are equal."""
    r, rows = random.Random(seed), []
    for c in range(n):
        said = "hot" if r.random() < hot else f"start {r.randint(0, n // 4)}"
        for t in range(r.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t, ("user", "assistant")[t % 2], f"{said} {t} {r.randint(0, 2)}"))
    return rows


@pytest.mark.parametrize("block", [T.BLOCK, 5])
def test_equals_brute_force(spark, block):
    rows = talk(150, 1)
    assert run(spark, rows, block=block) == brute(rows)


def test_long_conversations_split_over_rounds(spark):
    # one conversation with most rows, a copy that ends earlier, and a fork in its middle; numbers that keep no head
    rows = [(c, t, "user", f"word {t}" if c != 5 or t < 60 else f"other {t}") for c, n in ((3, 300), (5, 120), (7, 40)) for t in range(n)]
    rows += [(20, 0, "user", "alone")]
    want = brute(rows)
    assert run(spark, rows, block=16) == want
    assert max(d for _, d in want) > 250


def test_hard_cases(spark, words):
    rows = [(0, None, None, None), (0, 2, "user", "x  y\tz"), (0, 1, "user", ""), (1, 0, None, None), (1, 0, None, None), (4, 0, "a", "b"), (4, 0, "a", "b"),
            (None, 0, "user", "lost"), (21, 5, "user", " ".join(words(30_000))), (41, 0, "user", "base is absent"), (45, 0, "user", "q")]
    assert run(spark, rows) == brute(rows)
    # a conversation that is empty once rebuilt ends at the root
    empty = next(c for c in range(41, 60) if zlib.crc32(str(c).encode()) % 4 == 3)
    got = run(spark, [(empty, 0, "user", "gone")])
    assert got == {(empty, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(empty).encode()).hexdigest())}
    assert run(spark, []) == {}


def test_hash_of_many_ends_goes_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(T, "ENDS", 7)
    rows = [(c, 0, "user", "same") for c in range(200)]
    assert run(spark, rows) == brute(rows)


def test_split_of_one_component():
    r = random.Random(5)
    for shape in (lambda i: i - 1, lambda i: 0, lambda i: r.randrange(i), lambda i: max(0, i - r.randint(1, 3))):
        n = 200
        parent = [-1, *(shape(i) for i in range(1, n))]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        order = sorted(range(n), key=depth.__getitem__)
        at = {v: i for i, v in enumerate(order)}
        parent = [at.get(parent[v], -1) for v in order]
        weight = [r.randint(1, 4) for _ in range(n)]
        values = [(r.randint(0, 9), 1) for _ in range(n)]
        want = [list(v) for v in values]
        for i in reversed(range(1, n)):
            weight[parent[i]] += weight[i]
            want[parent[i]] = [x + y for x, y in zip(want[parent[i]], want[i])]
        assert T.split(parent, weight, values) == want
