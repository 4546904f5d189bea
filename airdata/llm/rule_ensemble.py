"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of a text are native expressions. A small forest is grown on the
labelled documents; every path from a root to a node is a rule, a conjunction
of bounds. Lasso logistic regression weighs the rules and sets most weights to
zero. What is left is compiled into one column expression, so scoring is a
projection that neither shuffles nor leaves the JVM.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airdata.llm.common import computed, staged
from airdata.llm.quality_rules import SYMBOLS, neighbours, spaced, without, words_of

#: Statistics a score may use; all come from the text alone.
STATISTICS = ("words", "mean_word", "symbols", "bangs", "bars", "capitals", "digits", "points", "wide", "distinct_words",
              "stutter", "short_words", "long_words", "dup_lines", "mean_line")
#: Trees and depth of the forest, weight of the lasso, seed.
TREES, DEPTH, LASSO, SEED = 24, 3, 5e-4, 7

Bound = tuple[str, str, float]  # statistic, "<=" or ">", value


@dataclass(frozen=True)
class Rules:
    """A fitted ensemble: log odds = base + the weights of the rules that hold."""

    base: float
    weighted: tuple[tuple[tuple[Bound, ...], float], ...]

    def score(self) -> Column:
        """Probability of a good text, as an expression over the statistics."""
        odds = F.lit(self.base)
        for rule, weight in self.weighted:
            odds = odds + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def holds(rule: tuple[Bound, ...]) -> Column:
    out = F.lit(True)
    for name, op, value in rule:
        out = out & ((F.col(name) <= value) if op == "<=" else (F.col(name) > value))
    return out


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the STATISTICS (double, never null) of a text; null counts as empty, and an empty text has zeros."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = computed(docs, _spaced=spaced(t), _lines=F.split(t, "\n"))
    d = computed(d, _words=words_of(F.col("_spaced")), _solid=F.replace("_spaced", F.lit(" "), F.lit("")))
    d = computed(d, _n=F.size("_words"), _chars=F.char_length("_solid"), _bytes=F.octet_length("_solid"))

    def part(n: Column, of: Column) -> Column:
        return F.when(of > 0, n / of).otherwise(F.lit(0.0)).cast("double")

    def lost(signs: str) -> Column:
        return F.col("_bytes") - F.octet_length(without(F.col("_solid"), signs))

    chars, n = F.col("_chars"), F.col("_n")
    made = {
        "words": F.log1p(n.cast("double")), "mean_word": part(chars, n), "symbols": part(lost(SYMBOLS.replace("|", "")), chars), "bangs": part(lost("!"), chars),
        "bars": part(lost("|"), chars), "capitals": part(F.octet_length(F.regexp_replace("_solid", "[^A-Z]+", "")), chars),
        "digits": part(F.octet_length(F.regexp_replace("_solid", "[^0-9]+", "")), chars), "points": part(lost(".,"), chars),
        "wide": part(F.col("_bytes") - chars, chars), "distinct_words": part(F.size(F.array_distinct("_words")), n),
        "stutter": part(F.aggregate(neighbours(F.col("_words"), 1, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda a, x: a + x), n),
        "short_words": part(F.size(F.filter("_words", lambda w: F.octet_length(w) <= 2)), n), "long_words": part(F.size(F.filter("_words", lambda w: F.octet_length(w) > 14)), n),
        "dup_lines": part(F.size("_lines") - F.size(F.array_distinct("_lines")), F.size("_lines")), "mean_line": F.log1p(chars / F.size("_lines")),
    }
    return computed(d, **{s: made[s] for s in STATISTICS}).select(*docs.columns, *STATISTICS)


def paths(tree: str) -> set[tuple[Bound, ...]]:
    """The rules of a tree, from its description: the path to every node below the root, bounds merged."""
    out, stack = set(), []
    for line in tree.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth, bound = len(m[1]), (STATISTICS[int(m[2])], m[3], float(m[4]))
            stack = [(d, b) for d, b in stack if d < depth] + [(depth, bound)]
            tight: dict[tuple[str, str], float] = {}
            for _, (name, op, value) in stack:
                pick = min if op == "<=" else max
                tight[name, op] = pick(value, tight.get((name, op), value))
            out.add(tuple(sorted((n, o, v) for (n, o), v in tight.items())))
    return out


def fit(labelled: DataFrame, label: str = "label", trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO, seed: int = SEED) -> Rules:
    """Fit the ensemble to rows with the STATISTICS and a label of 0 or 1; all of them, in distributed jobs.

    Without both labels there is nothing to tell apart: the score is then the
    smoothed share of good ones everywhere.
    """
    n, good = labelled.agg(F.count(F.lit(1)), F.sum(label)).first()
    good = good or 0
    if good in (0, n):
        return Rules(math.log((good + 1) / (n - good + 1)), ())
    data = labelled.select(array_to_vector(F.array(*STATISTICS)).alias("x"), F.col(label).cast("double").alias("y"))
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, maxBins=64, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=5, seed=seed).fit(data)
    rules = sorted(set().union(*(paths(t.toDebugString) for t in forest.trees)))
    if not rules:
        return Rules(math.log(good / (n - good)), ())
    held = labelled.select(array_to_vector(F.array(*[F.when(holds(r), 1.0).otherwise(0.0) for r in rules])).alias("x"), F.col(label).cast("double").alias("y"))
    held = staged(held, "rules")
    lasso_fit = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=80).fit(held)
    weighted = tuple((r, float(w)) for r, w in zip(rules, lasso_fit.coefficients.toArray()) if abs(w) > 1e-6)
    return Rules(float(lasso_fit.intercept), weighted)


def learn(docs: DataFrame, labels: DataFrame, condition: Column | None = None, key: str = "doc_id", text: str = "text") -> Rules:
    """Fit the ensemble to the labelled rows of docs; labels: key, label (0 or 1; others are no labels).

    ``condition`` on the key says which rows may be learned from.
    """
    stats = with_statistics(docs.select(key, text), text).drop(text)
    return _fit_to(stats, labels, condition, key)


def _fit_to(stats: DataFrame, labels: DataFrame, condition: Column | None, key: str) -> Rules:
    train = labels.filter(F.col("label").isin(0, 1)).join(stats if condition is None else stats.filter(condition), key)
    return fit(staged(train.select(*STATISTICS, "label"), "labelled"))


def keep(docs: DataFrame, rules: Rules, cut: float, text: str = "text") -> DataFrame:
    """The rows of docs that score ``cut`` or more, with all their columns, whatever their names."""
    d = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_given"))
    return with_statistics(d, "_given").filter(rules.score() >= cut).select("_row.*")


def classify(docs: DataFrame, labels: DataFrame, condition: Column | None = None, key: str = "doc_id", text: str = "text", cut: float = 0.3) -> tuple[DataFrame, Rules]:
    """Score every row of docs; returns the scored rows and the rules (see ``learn``).

    Adds score (double) and predicted (int, 1 from ``cut`` on) to the key.
    Texts that are null or empty are scored by their statistics like any other.
    Rows with equal keys are scored one by one; an empty table gives no rows.
    """
    stats = staged(with_statistics(docs.select(key, text), text).drop(text), "statistics")
    rules = _fit_to(stats, labels, condition, key)
    scored = stats.select(key, rules.score().alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0)), rules
