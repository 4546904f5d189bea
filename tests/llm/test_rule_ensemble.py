import math

import pytest
from pyspark.sql import functions as F

from airdata.llm import rule_ensemble as R
from airdata.llm.common import table

TREE = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=15
  If (feature 2 <= 0.1)
   If (feature 2 <= 0.05)
    Predict: 1.0
   Else (feature 2 > 0.05)
    Predict: 0.0
  Else (feature 2 > 0.1)
   Predict: 0.0
"""


def test_paths():
    assert R.paths(TREE) == {(("symbols", "<=", 0.1),), (("symbols", "<=", 0.05),), (("symbols", "<=", 0.1), ("symbols", ">", 0.05)), (("symbols", ">", 0.1),)}


def test_score_is_the_weighted_rules(spark, odd_docs):
    rules = R.Rules(0.5, (((("symbols", ">", 0.1),), -2.0), ((("words", ">", 3.0), ("bars", "<=", 0.0)), 1.25)))
    for r in R.with_statistics(odd_docs.select("doc_id", "text")).withColumn("p", rules.score()).collect():
        odds = 0.5 - 2.0 * (r.symbols > 0.1) + 1.25 * (r.words > 3 and r.bars <= 0)
        assert r.p == pytest.approx(1 / (1 + math.exp(-odds)))
        assert all(r[s] is not None and math.isfinite(r[s]) for s in R.STATISTICS)


def test_statistics(spark):
    d = spark.createDataFrame([(1, "Ab cd cd!!\nx|#1 é.,\nx|#1 é.,")], "doc_id long, text string")
    r = R.with_statistics(d).first()
    n, chars = 7, 22
    assert r.words == pytest.approx(math.log1p(n)) and r.mean_word == pytest.approx(chars / n) and r.bangs == pytest.approx(2 / chars)
    assert r.symbols == pytest.approx(2 / chars) and r.bars == pytest.approx(2 / chars) and r.digits == pytest.approx(2 / chars)
    assert r.capitals == pytest.approx(1 / chars) and r.points == pytest.approx(4 / chars) and r.wide == pytest.approx(2 / chars)
    assert r.distinct_words == pytest.approx(5 / n) and r.stutter == 0 and r.dup_lines == pytest.approx(1 / 3)


def test_hard_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 1), (10, 0), (11, 0), (None, 1), (7, None), (99, 0)], "doc_id long, label int")
    scored, rules = R.classify(odd_docs, labels)
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    one_kind, rules = R.classify(odd_docs, labels.filter("label = 1"))
    assert not rules.weighted and one_kind.filter("predicted = 1").count() == odd_docs.count()
    assert R.classify(no_docs, labels)[0].count() == 0
    assert R.classify(odd_docs, labels.limit(0))[0].select("score").distinct().collect()[0][0] == 0.5
    kept = R.keep(odd_docs, R.Rules(0.0, (((("words", "<=", 0.0),), -3.0),)), 0.3)
    assert kept.columns == odd_docs.columns and all((r.text or "").strip() for r in kept.collect())


def test_held_out_accuracy(spark):
    from airdata.llm.queries import op6_rule_ensemble

    sf = "/root/testdata/sf0.01"
    got = op6_rule_ensemble(spark, sf).join(table(spark, sf, "labels"), "doc_id").filter("held_out")
    good = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert good >= 0.9
    rows = got.select("quality", "score").collect()
    pairs = [(a.score > b.score) + 0.5 * (a.score == b.score) for a in rows for b in rows if a.quality > b.quality]
    assert sum(pairs) / len(pairs) >= 0.95
