import random

import pytest

SYLLABLES = "the of and to in er on an re ed nd ha at en es or ti hi as st ng le se it".split()


@pytest.fixture()
def words():
    """A maker of texts: words(n, seed) gives n words of invented syllables."""
    def make(n, seed=0):
        r = random.Random(seed)
        return ["".join(r.choices(SYLLABLES, k=r.randint(1, 4))) for _ in range(n)]
    return make


@pytest.fixture()
def odd_docs(spark, words):
    """Documents with every hard case: nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    base = " ".join(words(120, 1))
    near = base.replace(base.split()[60], "changed", 1)
    rows = [(1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "fr", "b", 2), (4, None, None, None, None), (5, "", "en", "b", 0),
            (6, " \t\n\x0b\x0c\r ", "en", "b", 0), (7, "one two", "en", None, 3), (8, "One  TWO", "en", "a", 3), (None, " ".join(words(50, 2)), "en", "a", 5),
            (None, None, None, None, None), (9, " ".join(words(30_000, 3)), "de", "c", 9), (10, "spam eggs " * 40, "en", "c", 9),
            (11, " ".join(words(60, 4)) + "\n" + "x | y\n" * 5 + "x | y", "es", "c", 9), (12, "naïve Ünïcode  　 文字 <|endoftext|> 's", "en", "a", 1),
            (12, "naïve Ünïcode  　 文字 <|endoftext|> 's", "en", "a", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    d = spark.createDataFrame(rows, schema)
    for i, c in enumerate(("size", "kept", "rank", "_words", "llr", "score", "_row", "unit", "_key", "block")):
        d = d.selectExpr("*", f"{i} as {c}")
    return d


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.limit(0)
