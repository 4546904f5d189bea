"""Language of a text by the nearest of several centroids.

A text is a bag of character n-grams: runs of one to LONGEST letters, lower-cased,
where everything between words is one gap. N-grams are hashed to WIDTH places;
a place weighs (1 + log of its count) * its inverse document frequency, and the
vector is normalised. A language has up to CENTROIDS centroids, found by
clustering its training documents by cosine, so that a language written in
several manners is not averaged into one. The nearest centroid tells the
language.

A centroid knows how far its own documents lie (mean and deviation of their
cosines). A text that is further from its nearest centroid than that allows is
rejected; one without letters has no vector and is rejected by all.

Document frequencies and the centroids' last sums come from all training
documents. Only the clustering before it looks at a sample: the FIT documents of
each language with the smallest hashes.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airdata.llm.common import groups, ship, staged

#: Letters of the longest n-gram, places they are hashed to.
LONGEST, WIDTH = 3, 1 << 15
#: Centroids of a language, rounds of clustering, documents of a language that are clustered.
CENTROIDS, ROUNDS, FIT = 4, 4, 512
#: Deviations from its mean cosine at which a centroid rejects a text.
FAR = 6.0
#: Characters of a text whose n-grams are taken at a time.
PIECE = 1 << 16
#: What a text without letters is said to be.
NONE = "und"


@functools.cache
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _places(chars: np.ndarray) -> np.ndarray:
    """Places of the n-grams of a run of code points, 0 for gaps, of which no two meet; a gap alone is none."""
    with np.errstate(over="ignore"):
        out, h = [], np.zeros(len(chars), np.uint32)
        for n in range(LONGEST):
            if len(chars) <= n:
                break
            h = (h[:len(chars) - n] ^ chars[n:]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            at = h * np.uint32(0x85EBCA6B) >> np.uint32(32 - WIDTH.bit_length() + 1)
            out.append(at[chars != 0] if n == 0 else at)
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The places of a text's n-grams, ascending, and how often each occurs; none without letters."""
    total = None
    if text:
        c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        c = np.where(_letters()[c], c, np.uint32(0))
        keep = c != 0
        if keep.any():
            keep[1:] |= keep[:-1].copy()  # one gap behind a word
            c = c[keep]
            c = np.concatenate([np.zeros(1, np.uint32), c, np.zeros(int(c[-1] != 0), np.uint32)])
            if len(c) <= 4096:
                return np.unique(_places(c), return_counts=True)
            for k in range(0, len(c), PIECE):  # pieces overlap by what an n-gram lacks
                got = _places(c[max(0, k - LONGEST + 1):k + PIECE])
                if k:  # what lies whole in the overlap was counted before
                    got_before = np.bincount(_places(c[k - LONGEST + 1:k]), minlength=WIDTH)
                    total += np.bincount(got, minlength=WIDTH) - got_before
                else:
                    total = np.bincount(got, minlength=WIDTH)
    if total is None:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    at = np.flatnonzero(total)
    return at, total[at]


def vector(text: str | None, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the normalised vector of a text."""
    at, n = counts(text)
    x = (1 + np.log(n)) * weights[at]
    norm = np.sqrt((x * x).sum())
    return at, x / norm if norm > 0 else x


@dataclass(frozen=True)
class Model:
    """Weights of the places; language, vector, mean cosine and deviation of each centroid."""

    weights: np.ndarray
    languages: tuple[str, ...]
    centroids: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray

    def nearest(self, text: str | None) -> tuple[int, float]:
        """Number of the nearest centroid and its cosine; -1 for a text without letters."""
        at, x = vector(text, self.weights)
        if not len(at):
            return -1, 0.0
        cosine = self.centroids[:, at] @ x
        c = int(np.argmax(cosine))
        return c, float(min(max(cosine[c], 0.0), 1.0))


def _schema(value: str) -> str:
    return f"lang string, cluster int, n long, s double, ss double, {value} binary"


def _summed(rows: DataFrame, value: str, to: tuple[str, ...]) -> list:
    """The arrays of doubles of rows (see _schema), added up by ``to`` on the executors: a row a group."""

    def run(batches):
        for g in groups(batches, *to):
            total = np.zeros(WIDTH)
            for b in g.column(value).to_pylist():
                total += np.frombuffer(b, np.float64)
            n, s, ss = (float(np.sum(g.column(c).to_numpy())) for c in ("n", "s", "ss"))
            yield pa.RecordBatch.from_pylist([{"lang": g.column("lang")[0].as_py(), "cluster": g.column("cluster")[0].as_py(), "n": int(n), "s": s, "ss": ss, value: total.tobytes()}],
                                             pa.schema([("lang", pa.string()), ("cluster", pa.int32()), ("n", pa.int64()), ("s", pa.float64()), ("ss", pa.float64()), (value, pa.binary())]))

    # one row a task and group comes in; salted, as all tasks have all groups
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    part = salted.repartition(*to, "salt").sortWithinPartitions(*to).drop("salt").mapInArrow(run, _schema(value))
    return part.repartition(*to).sortWithinPartitions(*to).mapInArrow(run, _schema(value)).orderBy("lang", "cluster").collect()


def document_frequencies(train: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Documents with letters of each language, and of each place over all languages."""

    def run(batches):
        n: dict[str, int] = {}
        df: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                at, _ = counts(text)
                if len(at):
                    n[lang] = n.get(lang, 0) + 1
                    df.setdefault(lang, np.zeros(WIDTH))[at] += 1
        for lang in n:
            yield pa.RecordBatch.from_pylist([{"lang": lang, "cluster": 0, "n": n[lang], "s": 0.0, "ss": 0.0, "df": df[lang].tobytes()}],
                                             pa.schema([("lang", pa.string()), ("cluster", pa.int32()), ("n", pa.int64()), ("s", pa.float64()), ("ss", pa.float64()), ("df", pa.binary())]))

    rows = _summed(staged(train.mapInArrow(run, _schema("df")), "frequencies"), "df", ("lang",))
    return {r["lang"]: r["n"] for r in rows}, sum((np.frombuffer(r["df"], np.float64) for r in rows), np.zeros(WIDTH))


def _assigned(train: DataFrame, model: Model, rounds: int) -> list:
    """Sums of the vectors of the documents by the centroid of their own language that is nearest."""
    of = {lang: [i for i, x in enumerate(model.languages) if x == lang] for lang in set(model.languages)}

    def run(batches):
        sums: dict[int, list] = {}
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                at, x = vector(text, model.weights)
                if len(at):
                    cosine = model.centroids[of[lang]][:, at] @ x
                    k = int(np.argmax(cosine))
                    r = sums.setdefault(of[lang][k], [0, 0.0, 0.0, np.zeros(WIDTH)])
                    r[0], r[1], r[2] = r[0] + 1, r[1] + cosine[k], r[2] + cosine[k]**2
                    r[3][at] += x
        for i, (n, s, ss, v) in sums.items():
            yield pa.RecordBatch.from_pylist([{"lang": model.languages[i], "cluster": i, "n": n, "s": s, "ss": ss, "v": v.tobytes()}],
                                             pa.schema([("lang", pa.string()), ("cluster", pa.int32()), ("n", pa.int64()), ("s", pa.float64()), ("ss", pa.float64()), ("v", pa.binary())]))

    return _summed(staged(train.mapInArrow(run, _schema("v")), f"centroids-{rounds}"), "v", ("lang", "cluster"))


def fit(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Learn from the rows of docs where ``learn`` holds and lang is not null; None if no text there has letters."""
    train = docs.filter(learn & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    ship(docs.sparkSession)
    slim = train.select("lang", "text")
    n, df = document_frequencies(slim)
    if not n:
        return None
    weights = np.where(df > 0, np.log((1 + sum(n.values())) / (1 + df)) + 1, 0.0)
    # the sample that is clustered: by language, the smallest hashes of key and text among texts with letters;
    # the cut is found from hashes alone, a few hundred a task and then a few hundred a group of tasks
    lettered = train.filter(F.regexp_like("text", F.lit(r"\p{L}"))).withColumn("hash", F.xxhash64("key", "text"))
    cut = lettered.select("lang", "hash").distinct().withColumn("part", F.pmod("hash", F.lit(64)))
    for by in (["lang", "part"], ["lang"]):
        cut = cut.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("hash"))).filter(F.col("place") <= FIT)
    last = {r["lang"]: r["hash"] for r in cut.groupBy("lang").agg(F.max("hash").alias("hash")).collect()}  # a row a language
    if not last:
        return None
    within = F.element_at(F.create_map(*[F.lit(x) for kv in last.items() for x in kv]), F.col("lang"))
    sample = lettered.filter(F.col("hash") <= within).dropDuplicates(["lang", "hash"])
    sample = staged(sample.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).select("lang", "text", "place"), "sample")

    def run(batches):  # vectors, whose size is bounded, and not texts
        for b in batches:
            for lang, text, at in zip(*(b.column(c).to_pylist() for c in ("lang", "text", "place"))):
                where, x = vector(text, weights)
                if len(where):
                    yield pa.RecordBatch.from_pylist([{"lang": lang, "place": at, "at": where.astype(np.int32).tobytes(), "x": x.tobytes()}],
                                                     pa.schema([("lang", pa.string()), ("place", pa.int32()), ("at", pa.binary()), ("x", pa.binary())]))

    few = sample.filter(F.col("place") <= 8 * CENTROIDS).select("lang", "text", "place")
    starts = few.mapInArrow(run, "lang string, place int, at binary, x binary").orderBy("lang", "place").collect()  # 32 a language
    languages, centroids = [], []
    for one in sorted(n):  # the first text, then always the one furthest from those chosen
        texts = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["x"], np.float64)) for r in starts if r["lang"] == one]
        dense = np.zeros((len(texts), WIDTH))
        for row, (at, x) in zip(dense, texts):
            row[at] = x
        chosen = [0] if texts else []
        while len(chosen) < min(CENTROIDS, len(texts)):
            close = (dense @ dense[chosen].T).max(1)
            if close.min() > 1 - 1e-9:
                break
            chosen.append(int(np.argmin(close)))
        languages += [one] * len(chosen)
        centroids.append(dense[chosen])
    if not languages:
        return None
    model = Model(weights, tuple(languages), np.concatenate(centroids), np.zeros(0), np.zeros(0))
    for i in range(ROUNDS + 1):
        rows = _assigned(slim if i == ROUNDS else sample.select("lang", "text"), model, i)
        v = np.stack([np.frombuffer(r["v"], np.float64) for r in rows])
        mean = np.array([r["s"] / r["n"] for r in rows])
        spread = np.sqrt(np.maximum(np.array([r["ss"] / r["n"] for r in rows]) - mean**2, 0))
        model = Model(weights, tuple(r["lang"] for r in rows), v / np.maximum(np.sqrt((v * v).sum(1)), 1e-300)[:, None], mean, spread)
    return model


def predict(docs: DataFrame, model: Model | None, text: str = "text", reject: bool = True) -> DataFrame:
    """Add lang_pred, score (cosine of the nearest centroid) and rejected to the rows of docs.

    With ``reject`` a text too far from its nearest centroid gets NONE as well;
    without, only one that has no letters does. Columns of these names are replaced.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    if model is None:
        return docs.select(*names, F.lit(NONE).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    ship(docs.sparkSession)
    at, carried = docs.columns.index(text), [(i, c) for i, c in enumerate(docs.columns) if c in names]
    model = docs.sparkSession.sparkContext.broadcast(model)  # languages * CENTROIDS * WIDTH numbers

    def run(batches):
        m = model.value
        for b in batches:
            lang, score, far = [], [], []
            for t in b.column(at).to_pylist():
                c, cosine = m.nearest(t)
                away = c < 0 or cosine < m.mean[c] - FAR * max(m.deviation[c], 0.02)
                lang.append(NONE if c < 0 or away and reject else m.languages[c])
                score.append(cosine)
                far.append(away)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i, _ in carried), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(far, pa.bool_())], [*names, "lang_pred", "score", "rejected"])

    columns = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return docs.mapInArrow(run, f"{columns}, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame, learn: Column, reject: bool = True, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The language of every row of docs, learned from those where ``learn`` holds.

    Returns docs with lang_pred, score (0 to 1) and rejected. Nothing but the text
    has a part in a prediction. Null and empty texts, and texts without letters,
    are NONE with score 0 and rejected; texts are taken whole, whatever their
    length; of centroids at the same distance the first by language counts. Rows
    with a null lang teach nothing, repeated rows teach as often as they come, a
    null key is one like any other. Where nothing can be learned, and so for an
    empty table, all rows are NONE. Other columns go along, whatever their names.
    """
    return predict(docs, fit(docs, learn, key, text, lang), text, reject)
