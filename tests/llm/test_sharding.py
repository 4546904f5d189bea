import hashlib
from collections import Counter

import pytest

from airdata.llm import sharding as S

NAMES = [f"s{i}" for i in range(13)]


def plain_fill(names, slots):
    """Every shard's whole order of preference first, then turns."""
    def number(n, salt):
        return int(hashlib.md5(f"{salt}:{n}".encode()).hexdigest()[:15], 16)

    orders = [[(number(n, "offset") + j * (number(n, "skip") % (slots - 1) + 1)) % slots for j in range(slots)] for n in names]
    assert all(sorted(o) == list(range(slots)) for o in orders)
    table, free = {}, set(range(slots))
    while free:
        for k, o in enumerate(orders):
            if free:
                slot = next(x for x in o if x in free)
                free.remove(slot)
                table[slot] = k
    return [table[i] for i in range(slots)]


def test_fill():
    assert S.fill(NAMES, 251) == plain_fill(NAMES, 251)
    n = Counter(S.fill(NAMES))
    assert max(n.values()) - min(n.values()) <= 1
    before, after = S.fill(NAMES), S.fill([x for x in NAMES if x != "s5"])
    left = [i for i in range(len(NAMES)) if i != 5]
    moved = sum(a != 5 and left[b] != a for a, b in zip(before, after))
    assert moved < 0.1 * len(before)
    for bad in (([], 7), (["a", "a"], 7), (NAMES, 12), (NAMES, 11)):
        with pytest.raises(ValueError):
            S.fill(*bad)


def test_rows(spark, odd_docs, no_docs):
    got = S.assign_shards(odd_docs.selectExpr("*", "1 as slot", "2 as shard"), ["doc_id"], NAMES)
    table = S.fill(NAMES)
    for r in got.collect():
        text = "n" if r.doc_id is None else f"v{r.doc_id}"
        slot = int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % S.SLOTS
        assert (r.slot, r.shard) == (slot, NAMES[table[slot]])
    assert got.count() == odd_docs.count() and S.assign_shards(no_docs, ["doc_id"], NAMES).count() == 0
    hot = spark.range(20_000).selectExpr("id", "'one' as source")
    assert S.assign_shards(hot, ["source"], NAMES).select("shard").distinct().count() == 1
    n = [r["count"] for r in S.assign_shards(hot, ["source"], NAMES, spread=["id"]).groupBy("shard").count().collect()]
    assert len(n) == 13 and max(n) < 1.2 * min(n)


def test_written_shards(spark, odd_docs, tmp_dir):
    got = S.assign_shards(odd_docs.drop("_words"), ["doc_id"], NAMES)
    S.write_shards(got, f"{tmp_dir}/out", files_per_shard=2)
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert back.count() == got.count()
