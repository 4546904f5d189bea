import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airdata.llm import language as L

SYLLABLES = {"xx": "ba be bi bo bu da de di".split(), "yy": "ñu ñe lla lle que qui za zo".split(), "zz": "sch pf tz ung ück äh öl ich".split()}


def made(n, seed=0, words=30):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(sorted(SYLLABLES))
        text = " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(r.randint(1, words)))
        out.append((i, text.upper() if i % 7 == 0 else text, lang))
    return out


def grams(text):
    """Distinct character n-grams with their counts, by plain strings; a gap is a space."""
    c = "".join(ch if ch.isalpha() else " " for ch in text.lower()).split()
    s = " " + " ".join(c) + " "
    out = Counter()
    for n in range(1, L.LONGEST + 1):
        out.update(g for g in (s[i:i + n] for i in range(len(s) - n + 1)) if g.strip())
    return out


def test_counts_equal_plain_strings():
    for text in ("Hello, wörld! a", "x", "  The the THE 1 the ", "文字 ñ—é", "a" * 10):
        got = dict(zip(*(a.tolist() for a in L.counts(text))))
        place, want = {}, Counter()
        for g, n in grams(text).items():
            alone = np.array([0 if ch == " " else ord(ch) for ch in g], np.uint32)
            place[g] = int(L._places(alone)[-1])  # the last is the whole run
            want[place[g]] += n
        assert got == dict(want), text


def test_long_texts_are_counted_whole(monkeypatch):
    r = random.Random(4)
    text = " ".join("".join(r.choices("abcdeñü", k=r.randint(1, 9))) for _ in range(20_000))
    whole = [L.counts(text)]
    for piece in (97, 1000, 10**7):
        monkeypatch.setattr(L, "PIECE", piece)
        whole.append(L.counts(text))
    assert sum(whole[0][1]) > 200_000
    for at, n in whole[1:]:
        assert (at == whole[0][0]).all() and (n == whole[0][1]).all()


def docs_of(spark, rows):
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for i, c in enumerate(("score", "rejected", "place", "hash", "cluster")):
        d = d.selectExpr("*", f"{i} as {c}")
    return d


def test_model_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "CENTROIDS", 1)  # one centroid a language: the mean of its normalised vectors
    rows = made(90)
    docs = docs_of(spark, rows)
    learn = F.col("doc_id") % 3 != 1
    got = {r.doc_id: r for r in L.identify(docs, learn, reject=False).collect()}
    train = [(t, lang) for i, t, lang in rows if i % 3 != 1]
    df = Counter(p for t, _ in train for p in L.counts(t)[0].tolist())
    idf = {p: math.log((1 + len(train)) / (1 + n)) + 1 for p, n in df.items()}

    def vec(t):
        x = {p: (1 + math.log(n)) * idf[p] for p, n in zip(*(a.tolist() for a in L.counts(t))) if p in idf}
        norm = math.sqrt(sum(v * v for v in x.values())) or 1
        return {p: v / norm for p, v in x.items()}

    centre = defaultdict(Counter)
    for t, lang in train:
        for p, v in vec(t).items():
            centre[lang][p] += v
    for c in centre.values():
        norm = math.sqrt(sum(v * v for v in c.values()))
        for p in c:
            c[p] /= norm
    for i, t, _ in rows:
        cosine = {lang: sum(v * c[p] for p, v in vec(t).items()) for lang, c in centre.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert got[i].lang_pred == best and got[i].score == pytest.approx(min(cosine[best], 1), abs=1e-9)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    from airdata.llm.queries import op13_language_id
    told = {r.doc_id: r for r in op13_language_id(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(told) == len(rows)
    for r in rows:
        assert told[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= told[r.doc_id].score <= 1
    right = [told[r.doc_id].lang_pred == r.lang for r in rows if told[r.doc_id].held_out]
    assert sum(right) >= 0.98 * len(right)


def test_a_language_of_two_manners_has_centroids_for_both(spark):
    rows = [(i, t.upper() if i % 2 else "zq " * 20 + t, lang) for i, t, lang in made(200, 3)]
    model = L.fit(docs_of(spark, rows), F.lit(True))
    assert all(Counter(model.languages)[lang] > 1 for lang in SYLLABLES)
    assert (model.mean > 0).all() and np.allclose((model.centroids**2).sum(1), 1)


def test_far_texts_are_rejected(spark):
    rows = made(150, 1, words=60)
    odd = [(1000, "кириллица совсем другая письменность здесь", None), (1001, "12 345 !!", None), (1002, None, None), (1003, "", None)]
    docs = docs_of(spark, rows + odd)
    got = {r.doc_id: r for r in L.identify(docs, F.lit(True)).collect()}
    assert all(got[i].lang_pred == "und" and got[i].rejected for i in range(1000, 1004))
    assert sum(got[i].rejected for i, _, _ in rows) <= 5
    kept = {r.doc_id: r.lang_pred for r in L.identify(docs, F.lit(True), reject=False).collect()}
    assert kept[1000] in SYLLABLES and all(kept[i] == "und" for i in (1001, 1002, 1003))


def test_hard_cases(spark, odd_docs, no_docs):
    got = L.identify(odd_docs, F.lit(True), reject=False)
    assert got.count() == odd_docs.count() and set(odd_docs.columns) <= set(got.columns)
    told = {(r.doc_id, r.lang_pred) for r in got.collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (None, "und")} <= told and len({p for i, p in told if i == 12}) == 1
    assert all(p in {"en", "fr", "de", "es", "und"} for _, p in told)
    assert L.identify(no_docs, F.lit(True)).count() == 0
    nothing = L.identify(odd_docs, F.lit(False))
    assert {(r.lang_pred, r.score, r.rejected) for r in nothing.collect()} == {("und", 0.0, True)}
    again = {(r.doc_id, r.lang_pred, r.score) for r in L.identify(odd_docs.repartition(5), F.lit(True), reject=False).collect()}
    assert {(i, p) for i, p, _ in again} == told
