import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from airdata.llm import packing as P
from airdata.llm.tokens import vocabulary


def least_bins(items, capacity):
    """The fewest bins, by trying all placements."""
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i] and rooms[k] not in rooms[:k]:
                go(i + 1, [*rooms[:k], rooms[k] - items[i], *rooms[k + 1:]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def sequences(counts, capacity):
    out = defaultdict(list)
    for r in P.plan(counts, capacity):
        for k in range(r["first"], r["last"]):
            out[r["sequence"] + (k - r["first"]) // r["times"]].append((r["offset"] + (k - r["first"]) % r["times"] * r["length"], r["length"]))
    return out


@pytest.mark.parametrize("seed", range(60))
def test_reduction_loses_nothing(seed):
    r = random.Random(seed)
    capacity = r.choice([10, 20, 31])
    items = [r.randint(1, capacity) for _ in range(r.randint(1, 10))]
    fixed, left = P.reduce_dominated(Counter(items), capacity)
    used = Counter(left)
    for lengths, n in fixed:
        assert sum(lengths) <= capacity
        for x in lengths:
            used[x] += n
    assert used == Counter(items)
    rest = [x for x, n in left.items() for _ in range(n)]
    assert sum(n for _, n in fixed) + least_bins(rest, capacity) == least_bins(items, capacity)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_a_packing(seed):
    r = random.Random(seed)
    counts = Counter(min(2048, max(1, int(r.lognormvariate(5.5, 1.2)))) for _ in range(3000))
    counts[2048] += 500
    out = sequences(counts, 2048)
    assert Counter(x for s in out.values() for _, x in s) == counts
    for s in out.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert sorted(out) == list(range(len(out)))
    assert len(out) <= -(-sum(x * n for x, n in counts.items()) // 2048) * 1.01 + 1


def test_documents(spark, odd_docs, no_docs):
    path = vocabulary("byte_bpe_50k.json")
    got = P.pack_documents(odd_docs, path, 0).collect()
    whole = Tokenizer.from_file(path)
    want = Counter(tuple([*whole.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in odd_docs.collect())
    by_doc = defaultdict(list)
    for g in got:
        assert len(g.ids) == 4 * g.length
        by_doc[g.doc_id].append(g)
    seen = Counter()
    for rows in by_doc.values():
        copies = max(Counter(g.piece for g in rows).values())
        if copies == 1:
            rows.sort(key=lambda g: g.piece)
            assert [g.start for g in rows] == [0, *itertools.accumulate(g.length for g in rows)][:-1]
            assert all(g.length == 2048 for g in rows[1:])
            seen[tuple(np.frombuffer(b"".join(g.ids for g in rows), "<u4").tolist())] += 1
        else:
            for g in rows:
                seen[tuple(np.frombuffer(g.ids, "<u4").tolist())] += 1
    assert seen == want
    places = defaultdict(list)
    for g in got:
        places[g.sequence_id].append((g.offset, g.length))
    for s in places.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert P.pack_documents(no_docs, path, 0).count() == 0


def test_query_digests(spark, sf_dir):
    from airdata.llm.queries import op4_packing

    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = {(r.doc_id, r.piece): r for r in op4_packing(spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = [*whole.encode(d.text or "", add_special_tokens=False).ids, 0]
        p, at = 0, 0
        while at < len(ids):
            r = got.pop((d.doc_id, p))
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at, p = at + r.length, p + 1
        assert at == len(ids)
    assert not got
