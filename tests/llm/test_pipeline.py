from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as C
from airdata.llm import common, quality_rules, rule_ensemble
from tests.llm import test_minhash, test_mixing, test_packing, test_quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = common.table(spark, sf_dir, "documents"), []
    for name, f in C.STAGES:
        before, docs = docs, common.staged(f(spark, docs, sf_dir), name)
        out.append((before, docs))
    return out


def rows(d):
    return [tuple(r) for r in d.select(*COLUMNS).collect()]


def test_columns(stages):
    assert [n for n, _ in C.STAGES] == ["quality_rules", "quality_classifier", "minhash_near_dedup", "mixing", "best_fit_packing"]
    for _, after in stages[:-1]:
        assert after.columns == COLUMNS


def test_quality_rules_stage(spark, sf_dir, stages):
    before, after = map(rows, stages[0])
    trusted = {r.doc_id for r in common.table(spark, sf_dir, "labels").filter("quality = 1").collect()}
    want = {i for i, *_, failed, llr in test_quality_rules.brute([r[:2] for r in before], trusted) if not failed and llr >= quality_rules.THRESHOLD}
    assert {r[0] for r in after} == want and len(after) == len(want) < len(before)


def test_quality_classifier_stage(spark, sf_dir, stages):
    before, after = map(rows, stages[1])
    good = {r.doc_id: r.quality for r in common.table(spark, sf_dir, "labels").collect()}
    kept = {r[0] for r in after}
    assert set(after) <= set(before)
    clean = [r[0] for r in before if good.get(r[0]) == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)


def test_near_dedup_stage(stages):
    before, after = map(rows, stages[2])
    component, _ = test_minhash.brute([r[:2] for r in before], 5, 80)
    assert sorted(r[0] for r in after) == sorted(i for i, c in component.items() if i == c)


def test_mixing_stage(stages):
    before, after = map(rows, stages[3])
    assert set(after) <= set(before) and max(Counter(after).values()) <= 3
    words = lambda r: len((r[1] or "").encode().split())
    sizes, taken = Counter(), Counter()
    for r in before:
        sizes[r[3]] += words(r)
    for r in after:
        taken[r[3]] += words(r)
    for s, t in test_mixing.brute_targets(sizes).items():
        assert abs(taken[s] - t) <= max(0.1 * t, max(words(r) for r in before if r[3] == s))


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    from airdata.llm.tokens import vocabulary

    before, packed = stages[4]
    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = sum(len(whole.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in rows(before))
    got = packed.collect()
    assert sum(g.length for g in got) == want
    ends = Counter()
    for g in got:
        ends[g.sequence_id] += g.length
    assert max(ends.values()) <= 2048 and len(ends) <= -(-want // 2048) * 1.02 + 1


def test_stages_on_hard_cases(spark, sf_dir, odd_docs, no_docs):
    docs = odd_docs.select(*COLUMNS)
    for name, f in C.STAGES[:-1]:
        for d in (odd_docs, no_docs):
            out = f(spark, d, sf_dir)
            assert out.columns == d.columns and out.count() <= 3 * d.count(), name
    assert C.near_dedup_stage(spark, docs.unionByName(docs), sf_dir).filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").count() == 0
    # the last stage: extra columns with clashing names, and no rows
    for d in (docs, odd_docs):
        assert C.packing_stage(spark, d, sf_dir).select("doc_id").distinct().count() == d.select("doc_id").distinct().count()
    assert C.packing_stage(spark, no_docs, sf_dir).count() == 0


def test_near_dedup_stage_judges_rows(spark, words):
    a, b, c = (" ".join(words(80, seed)) for seed in (1, 2, 3))
    data = [(1, a), (1, b), (2, a), (3, c), (3, c), (None, c), (None, b + " more"), (None, None), (4, None), (4, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    want = [(1, a), (1, b), (3, c), (4, None), (None, None)]
    for d in (docs, docs.repartition(3, "text"), docs.orderBy(docs.text.desc())):
        assert Counter(tuple(r) for r in C.near_dedup_stage(spark, d, "").collect()) == Counter(want)
    alone = docs.filter("doc_id is null")
    assert C.near_dedup_stage(spark, alone.unionByName(alone), "").filter("text is not null").count() == 2
