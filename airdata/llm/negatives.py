"""Hard negatives by inner product, found by coordinate pruning in length buckets.

Rows are put in the order of label and length (the Euclidean norm, longest
first) and cut into buckets of BUCKET rows, so a bucket holds rows of like
length and mostly of one label, and no label or length makes it larger. A bucket
holds its normalised vectors as one sorted list a coordinate.

An anchor asks a bucket for the rows whose score reaches a bound. With the
longest row of the bucket the bound becomes a least cosine, and so a largest
angle to the anchor; with it, every coordinate has a range of feasible values.
The ranges of the anchor's FOCUS largest coordinates are looked up in the sorted
lists, the rows in all of them are the candidates, and their scores are taken
exactly. A bucket whose least cosine is above 1 isn't asked at all, and no copy
of the anchor is sent to it.

Positives: a bucket of the anchor's own label gives the bound to begin with, the
score of its fifth row or less; the other buckets of the label are asked with it.
Negatives: the bound of a positive is four fifths of its score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airdata.llm.common import groups, ship, staged
from airdata.operators.scan import numbered

#: Rows of a bucket, anchors that one task puts to it at a time, and coordinates looked at.
BUCKET, ASKING, FOCUS = 1024, 512, 6
#: Positives of an anchor, negatives of a positive, and the least share of the positive's score in per cent.
POSITIVES, NEGATIVES, SHARE = 5, 5, 80
#: Components and scores are exact up to here.
EXACT = 2**53
#: Room for rounding in cosines.
SLACK = 1e-9


def usable(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """key, label, vector (array<double> of whole numbers) and norm of the rows that take part.

    Of rows that share a key, the one with the least label, then vector, counts.
    """
    d = df.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    d = d.filter("key is not null and label is not null and vector is not null")
    d = d.filter(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    d = d.groupBy("key").agg(F.min(F.struct("label", "vector")).alias("r")).select("key", "r.label", "r.vector")
    d = d.withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("double")))
    return d.withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))


class Bucket:
    """Rows of like length with a sorted list for each coordinate, made when it is asked for."""

    def __init__(self, keys: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.keys, self.labels, self.x = keys, labels, x
        self.norms = np.sqrt((x * x).sum(1))
        self.longest = self.norms.max(initial=0.0)
        self.unit = x / np.where(self.norms > 0, self.norms, 1)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.exact = np.abs(x).sum(1).max(initial=0.0)

    def list_of(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows in the order of coordinate f, and its values in that order."""
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def candidates(self, q: np.ndarray, norm: float, least: float) -> np.ndarray:
        """Rows that can score ``least`` or more with q, and perhaps others."""
        if least <= 0 or norm == 0:  # a zero row scores 0, and no angle is too large
            return np.arange(len(self.keys)) if least <= 0 else np.empty(0, np.int64)
        cosine = least / (norm * max(self.longest, 1e-300)) - SLACK
        if cosine > 1:
            return np.empty(0, np.int64)
        wide = np.arccos(cosine)
        focus = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
        at = np.arccos(np.clip(q[focus] / norm, -1, 1))
        low, high = np.cos(np.minimum(np.pi, at + wide)) - SLACK, np.cos(np.maximum(0, at - wide)) + SLACK
        ranges = []
        for f, lo, hi in zip(focus, low, high):
            order, values = self.list_of(int(f))
            i, j = np.searchsorted(values, lo, "left"), np.searchsorted(values, hi, "right")
            ranges.append((j - i, i, order, int(f), lo, hi))
        n, i, order, first, *_ = min(ranges, key=lambda r: r[0])
        found = order[i:i + n]  # the shortest list; the other ranges are tested on what it holds
        for _, _, _, f, lo, hi in ranges:
            if f != first and len(found):
                v = self.unit[found, f]
                found = found[(v >= lo) & (v <= hi)]
        return found

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.exact * np.abs(q).max(initial=0.0) < EXACT:
            return (self.x[rows] @ q).astype(np.int64)
        whole = [int(v) for v in q]  # beyond doubles; beyond longs scores stop at their ends
        return np.array([min(max(sum(int(a) * b for a, b in zip(r, whole)), -2**63), 2**63 - 1) for r in self.x[rows]], np.int64)


def best(keys: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller key."""
    if len(keys) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(keys))
    return near[np.lexsort((keys[near], -scores[near]))][:k]


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def asked(rows: DataFrame, asks: DataFrame, same: bool, k: int) -> DataFrame:
    """For every bound of every ask the best k rows of the bucket it goes to.

    rows: bucket, key, label, vector. asks: bucket, key, label, vector and bounds,
    an array of (part, least, most): scores from least to most, null for no end.
    Returns anchor, part, key, score. ``same``: rows of the anchor's own label,
    without itself; else rows of other labels.
    """
    ship(rows.sparkSession)
    turns = F.greatest(F.lit(1), F.ceil(asks.groupBy("bucket").count().agg(F.max("count")).scalar() / ASKING)).cast("int")
    data = rows.join(asks.select("bucket").distinct(), "bucket", "left_semi")  # only buckets that are asked
    data = data.select("bucket", F.explode(F.sequence(F.lit(0), turns - 1)).alias("turn"), F.lit(0).alias("kind"), "key", "label", "vector", F.lit(None).cast(asks.schema["bounds"].dataType).alias("bounds"))
    wants = asks.select("bucket", F.pmod(F.xxhash64("key"), turns).cast("int").alias("turn"), F.lit(1).alias("kind"), "key", "label", "vector", "bounds")
    both = data.unionByName(wants).repartition("bucket", "turn").sortWithinPartitions("bucket", "turn", "kind", "key")

    def run(batches):
        for g in groups(batches, "bucket", "turn"):
            kind, key, label = (g.column(c).to_numpy() for c in ("kind", "key", "label"))
            n = int((kind == 0).sum())
            if not n or n == len(key):
                continue
            vectors, bounds = g.column("vector").to_pylist(), g.column("bounds").slice(n).to_pylist()
            x = _matrix(vectors, max(map(len, vectors)))
            bucket, out = Bucket(key[:n], label[:n], x[:n]), []
            for i in range(n, len(key)):
                q, wanted = x[i], bounds[i - n]
                near = bucket.candidates(q, float(np.sqrt((q * q).sum())), min(w["least"] for w in wanted))
                mine = bucket.labels[near] == label[i]
                near = near[mine & (bucket.keys[near] != key[i]) if same else ~mine]
                score = bucket.scores(near, q)
                for w in wanted:
                    ok = score >= w["least"]
                    ok = np.flatnonzero(ok if w["most"] is None else ok & (score <= w["most"]))
                    top = ok[best(bucket.keys[near[ok]], score[ok], k)]
                    out.append((np.full(len(top), key[i]), np.full(len(top), w["part"]), bucket.keys[near[top]], score[top]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], ["anchor", "part", "key", "score"])

    return both.mapInArrow(run, "anchor long, part long, key long, score long")


def first(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each anchor and part, with their rank."""
    order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(df: DataFrame, is_anchor, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE) -> DataFrame:
    """Rows of other labels that score nearly as high with an anchor as its positives do.

    A component counts as floor(scale * x), a score is an inner product of such
    numbers. ``is_anchor`` is a condition on the column ``key``. An anchor's positives are the
    ``positives`` best other rows of its label; of each, the first ``negatives``
    rows of other labels with share * positive_score <= 100 * score <= 100 *
    positive_score are returned: anchor_id, positive_id, rank (int, from 1),
    negative_id, positive_score, negative_score. Higher scores come first, ties by
    the smaller key.

    Rows with a null key, label or vector, or a null or non-finite component take
    no part. Numbers beyond 64 bits stop at their ends. Shorter vectors count as filled up with zeros, so an empty one scores
    0 with all. Repeated rows count once. An empty table, or one without anchors,
    gives no rows; other columns play no part.
    """
    spark = df.sparkSession
    made = staged(usable(df, key, vector, label, scale).withColumn("back", -F.col("norm")), "vectors")
    rows = staged(numbered(made, ["label", "back", "key"], "at")
                  .select(F.floor((F.col("at") - 1) / BUCKET).alias("bucket"), "key", "label", "vector", "norm"), "buckets")
    length = staged(rows.groupBy("bucket").agg(F.max("norm").alias("longest"), F.min("label").alias("low"), F.max("label").alias("high")), "lengths")
    # a row a label and bucket, from which a label's first bucket, and its others, can be told
    of_label = staged(rows.groupBy("label", "bucket").agg(F.max("norm").alias("longest")), "label-buckets")
    anchors = staged(rows.filter(is_anchor), "anchors")
    slim = ["key", "label", "norm"]

    def bound(part, least, most):
        return F.struct(part.cast("long").alias("part"), least.cast("long").alias("least"), most.cast("long").alias("most"))

    def sent(asks):  # the vector joins last, where an ask is known to go
        return staged(asks.select("bucket", "key", "bounds").join(anchors.select("key", "label", "vector"), "key"), "asks")

    def reaches(least):  # the least cosine is at most 1
        return (least <= 0) | (least <= F.col("norm") * F.col("longest") * (1 + SLACK) + SLACK)

    # the bucket of the anchor's label with the longest rows gives a bound
    lead, any_score, none = of_label.groupBy("label").agg(F.min("bucket").alias("bucket")), F.lit(-2**63), F.lit(None)
    seeds = anchors.select(*slim).join(lead, "label").withColumn("bounds", F.array(bound(F.lit(0), any_score, none)))
    found = staged(asked(rows, sent(seeds), True, positives), "seeds")
    known = found.groupBy("anchor").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n")).select(F.col("anchor").alias("key"), F.when(F.col("n") >= positives, F.col("s")).alias("s"))
    others = of_label.join(lead.withColumnRenamed("bucket", "lead"), "label").filter("bucket <> lead").drop("lead")
    asks = anchors.select(*slim).join(known, "key", "left").withColumn("least", F.coalesce("s", any_score)).join(others, "label")
    asks = asks.filter(reaches(F.col("least"))).withColumn("bounds", F.array(bound(F.lit(0), F.col("least"), none)))
    near = staged(first(found.unionByName(asked(rows, sent(asks), True, positives)), positives), "positives")

    # a positive below zero has no score between its share and itself
    least = F.ceil(F.col("score").cast("decimal(20,0)") * share / 100)
    wanted = near.filter("score >= 0").select(F.col("anchor").alias("key"), bound(F.col("key"), least, F.col("score")).alias("b"))
    wanted = wanted.groupBy("key").agg(F.collect_list("b").alias("bounds"), F.min("b.least").alias("least"))  # `positives` a key at most
    n = F.coalesce(length.agg(F.max("bucket")).scalar(), F.lit(0).cast("long"))
    asks = anchors.select(*slim).join(wanted, "key").withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), n)))
    alone = (F.col("low") == F.col("high")) & (F.col("low") == F.col("label"))
    asks = asks.join(length, "bucket").filter(reaches(F.col("least")) & ~alone)
    far = first(asked(rows, sent(asks), False, negatives), negatives)
    of_anchor = near.select("anchor", F.col("key").alias("part"), F.col("score").alias("positive_score"))
    return far.join(of_anchor, ["anchor", "part"]).select(
        F.col("anchor").alias("anchor_id"), F.col("part").alias("positive_id"), "rank", F.col("key").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
