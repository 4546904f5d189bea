import math
import re
import struct
from collections import Counter

import pytest
import xxhash

from airdata.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def spark_hash(*parts):
    """Spark's xxhash64 of texts and longs: each is hashed with the last hash as seed."""
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else struct.pack("<q", p), seed=h & (2**64 - 1))
        h -= 2**64 if h >= 2**63 else 0
    return h


def base(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    n, rep = len(w), len(covered)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), rep, n < 20 or 100 * rep > 30 * n)


def grams(text):
    text = text or ""
    w = WORD.findall(text)
    runs = [spark_hash(x[:3]) for x in w] + [spark_hash(x[-3:]) for x in w]
    pairs = [spark_hash(-1 if a == b else (len(a) << 31) + len(b)) for a, b in zip(w, w[1:])]
    return [h % Q.BUCKETS for h in runs + pairs]


def brute(rows, trusted):
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if i in trusted:
            target.update(grams(t))
    r, t = sum(raw.values()), sum(target.values())
    out = []
    for i, text in rows:
        g = grams(text)
        x = [math.log((target[b] + 1) / (t + Q.BUCKETS)) - math.log((raw[b] + 1) / (r + Q.BUCKETS)) for b in g]
        out.append((i, *base(text), sum(x) / len(x) if g else None))
    return out


def check(got, want, trusted=True):
    key = lambda x: (x[0] is None, x[0] or 0, x[1:7])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:7] == w[:7]
        assert g[7] == (w[7] if w[7] is None else pytest.approx(w[7], abs=1e-4))
        if w[7] is None or abs(w[7] - Q.THRESHOLD) > 1e-3:
            assert g[8] == (not w[6] and w[7] is not None and (not trusted or w[7] >= Q.THRESHOLD))


def test_hard_cases(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    trusted = spark.createDataFrame([(1,), (1,), (9,), (None,)], "doc_id long")
    check(Q.quality_rules(odd_docs, trusted).collect(), brute(rows, {1, 9}))
    check(Q.quality_rules(odd_docs, trusted.limit(0)).collect(), brute(rows, set()), trusted=False)
    assert Q.quality_rules(no_docs, trusted).count() == 0
    kept = Q.keep(odd_docs, trusted)
    good = Q.quality_rules(odd_docs, trusted).filter("kept").collect()
    ids = lambda found: sorted(str(r.doc_id) for r in found)
    assert kept.columns == odd_docs.columns and ids(kept.collect()) == ids(good) and "9" in ids(good)


def test_query_equals_brute_force(spark, sf_dir):
    from airdata.llm.queries import op3_quality_rules, trusted_documents

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(op3_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept").collect(),
          brute(rows, {r.doc_id for r in trusted_documents(spark, sf_dir).collect()}))


def test_plan_is_native(spark, sf_dir, capsys):
    from airdata.llm.queries import op3_quality_rules, op5_sharding

    for f in (op3_quality_rules, op5_sharding):
        f(spark, sf_dir).explain()
        plan = capsys.readouterr().out
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_threshold_means_the_same_at_every_size(spark):
    from airdata.llm.common import table
    from airdata.llm.queries import op3_quality_rules

    for sf in ("sf0.01", "sf0.1"):
        path = f"/root/testdata/{sf}"
        good = {r.doc_id: r.quality for r in table(spark, path, "labels").collect()}
        judged = op3_quality_rules(spark, path).filter("not base_failed").select("doc_id", "kept").collect()
        kept = {q: [r.kept for r in judged if good.get(r.doc_id) == q] for q in (0, 1)}
        assert sum(kept[0]) <= 0.08 * len(kept[0]) and sum(kept[1]) >= 0.97 * len(kept[1]), sf


def test_good_documents_outside_the_trusted_ones_stay(spark):
    from airdata.llm.common import table
    from airdata.llm.queries import remainder, trusted_documents

    path = "/root/testdata/sf0.1"
    docs, half = table(spark, path, "documents"), trusted_documents(spark, path)
    others = half.filter(remainder("doc_id", 2) == 1)
    judged = Q.quality_rules(docs, half.filter(remainder("doc_id", 2) == 0)).join(others, "doc_id", "left_semi").filter("not base_failed")
    rows = judged.select("kept").collect()
    assert rows and sum(r.kept for r in rows) >= 0.999 * len(rows)


def test_grams_of_odd_words(spark):
    texts = ["", "a", "ab abc abcd abcd", "x" * 4097, "ab 文字é " * 3000, "𝒳y\n" * 2731]
    d = Q.with_words(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"))
    for r in d.select("text", Q.grams(Q.BUCKETS).alias("g")).collect():
        assert r.g == grams(r.text)


def test_gram_rows_are_compiled_and_equal_the_grams(spark, capsys):
    texts = ["", None, "a", "ab abc abcd abcd", "x" * 4097, "a a a \t b", "𝒳y\n" * 31]
    d = Q.with_words(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"))
    rows = Q.gram_rows(d, Q.BUCKETS, "i")
    got = {i: Counter() for i in range(len(texts))}
    for r in rows.collect():
        got[r.i][r.bucket] += 1
    assert got == {i: Counter(grams(t)) for i, t in enumerate(texts)}
    rows.explain()
    assert "lambda" not in capsys.readouterr().out
