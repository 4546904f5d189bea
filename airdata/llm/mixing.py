"""Mixing sources to target weights by the cube method of balanced sampling.

Each source has a target of words. A document of a source with rate
``target / size of the source`` is taken ``floor(rate)`` times for certain and
once more with the fraction that is left as its inclusion probability. The cube
method chooses those: the vector of probabilities walks through the null space
of the constraints (number of documents, number of words) until almost every
probability is 0 or 1. Each step uses three open documents, finds the
direction that changes neither total and goes along it, one way or the other
with the odds that keep the probabilities, until one of the three is decided.

At scale each source is dealt into blocks; a few documents of all sizes are kept
out of the walk, which runs over the others of the block and leaves at most two
open. Kept and open ones go on to the next, coarser level. In the last block of
a source they are the landing problem: of all roundings, the one whose word
total is nearest. All choices hash the document, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from airdata.llm.common import ship, staged, utf8

#: Weights of the sources, in turn.
WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MOST = 3
#: Documents a block of the walk holds about.
BLOCK = 4096
#: Documents the landing problem of a source has at most; all its roundings are tried.
LANDING = 16
EPS = 1e-9


def with_size(df: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    """Add the number of words (maximal runs of bytes other than 0x20 and 0x09-0x0D); null has none."""
    ship(df.sparkSession)
    keep = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*keep, T.StructField(out, T.LongType())])
    names = [f.name for f in keep]

    def count(batches):
        for b in batches:
            n = pa.array([0 if t is None else len(t.split()) for t in utf8(b.column(text))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), n], [*names, out])

    return df.mapInArrow(count, schema)


def targets(sizes: DataFrame, weights=WEIGHTS, most: float = MOST) -> DataFrame:
    """The targets of the sources: one row a source with weight, target and rate.

    ``sizes``: source, source_size. The total of all sizes is shared by weight;
    a target stops at ``most`` times its source's size and the excess is shared
    again by weight among the others, until none is above. The level of that
    filling is found in one ordered pass: a source is capped exactly if its
    ratio of room to weight lies under the level, so the capped sources are a
    prefix in the order of that ratio.
    """
    # the table of sources: a row each, far smaller than the documents
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("weight", w).withColumn("room", F.col("source_size") * float(most))
    by_ratio = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    s = (s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("level", (F.col("total") - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(after)))
    # the first source in the order whose level doesn't reach its room, and all after it, stay below their cap
    s = s.withColumn("free", F.col("level") * F.col("weight") <= F.col("room"))
    s = s.withColumn("final", F.min(F.when(F.col("free"), F.struct(F.row_number().over(by_ratio).alias("k"), F.col("level").alias("l")))).over(everything)["l"])
    target = F.when(F.col("final").isNull(), F.col("room")).otherwise(F.least(F.col("final") * F.col("weight"), F.col("room")))
    return (s.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0)))
            .select("source", "source_size", "weight", "target", "rate"))


def walk(size: list[float], pi: list[float], draw: list[float]) -> list[float]:
    """Flight phase over one block: at most two of the returned probabilities lie between 0 and 1.

    Balanced totals: documents (1 each) and words (``size`` each). ``draw``
    holds one number in [0, 1) a document, which decides the way of each step.
    """
    pi = list(pi)
    open_: list[int] = []
    for k in range(len(pi)):
        if pi[k] <= EPS or pi[k] >= 1 - EPS:
            pi[k] = 0.0 if pi[k] < 0.5 else 1.0
            continue
        open_.append(k)
        while len(open_) == 3:
            a, b, c = open_
            # null space of [[1, 1, 1], [size a, b, c]]; equal sizes leave a wider one
            u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
            if not any(u):
                u = (1.0, -1.0, 0.0)
            up = down = math.inf
            for i, x in zip(open_, u):
                if x > 0:
                    up, down = min(up, (1 - pi[i]) / x), min(down, pi[i] / x)
                elif x < 0:
                    up, down = min(up, pi[i] / -x), min(down, (1 - pi[i]) / -x)
            step = up if draw[c] * (up + down) < down else -down
            for i, x in zip(open_, u):
                p = pi[i] + step * x
                pi[i] = 0.0 if p <= EPS else 1.0 if p >= 1 - EPS else p
            open_ = [i for i in open_ if 0 < pi[i] < 1]
    return pi


def reserve(size: list[float], most: int = LANDING - 2) -> list[int]:
    """Documents kept open for the landing: up to ``most``, at even steps through the upper two thirds in the order of size.

    They are large enough to make up for a large document that the walk leaves
    open; the largest itself is left to the walk.
    """
    by_size = sorted((k for k in range(len(size)) if size[k] > 0), key=lambda k: size[k])
    if len(by_size) <= most:
        return by_size
    pool = by_size[min(len(by_size) // 3, len(by_size) - most - 1):-1]
    return sorted({pool[round(i * (len(pool) - 1) / (most - 1))] for i in range(most)})


def land(size: list[float], pi: list[float]) -> list[float]:
    """Landing phase: of all roundings of the open documents, the one with the nearest words, then the nearest number."""
    pi = list(pi)
    left = [k for k, p in enumerate(pi) if 0 < p < 1]
    if left:
        picks = (np.arange(2 ** len(left))[:, None] >> np.arange(len(left))) & 1
        p, w = np.array([pi[k] for k in left]), np.array([size[k] for k in left])
        best = np.lexsort((np.abs(picks.sum(1) - p.sum()), np.abs(picks @ w - p @ w)))[0]
        for k, x in zip(left, picks[best]):
            pi[k] = float(x)
    return pi


def choose(units: DataFrame, stratum: list[str], block: int = BLOCK) -> DataFrame:
    """The cube method over ``units`` (unit, *stratum, size, pi, draw): adds ``chosen`` (0.0 or 1.0).

    ``unit`` identifies a document and ``draw`` is a hash of it in [0, 1). Every
    level deals each stratum into blocks of about ``block`` open documents by
    hash, so a stratum with a large part of all rows is many blocks. A block
    must be well larger than LANDING, by which every level shrinks it.
    """
    decided, open_, level = [], units, 0
    while True:
        n = open_.groupBy(*stratum).agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
        same = F.lit(True)
        n = n.select(*[F.col(c).alias(f"_{c}") for c in stratum], "blocks")
        for c in stratum:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        dealt = (open_.join(n, same).drop(*[f"_{c}" for c in stratum])
                 .withColumn("block", F.pmod(F.xxhash64("unit", F.lit(level)), F.col("blocks"))))
        schema = T.StructType([*open_.schema.fields, T.StructField("landed", T.BooleanType())])
        names = units.columns

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values([c for c in ("draw", "unit", "size", "_content") if c in pdf], kind="stable")
            size, draw = pdf["size"].astype(float).tolist(), pdf["draw"].tolist()
            pi, whole = pdf["pi"].tolist(), pdf["blocks"].iloc[0] == 1
            aside = {k: pi[k] for k in reserve(size) if EPS < pi[k] < 1 - EPS}
            pi = walk(size, [0.0 if k in aside else p for k, p in enumerate(pi)], draw)
            pi = [aside.get(k, p) for k, p in enumerate(pi)]
            if whole:
                pi = land(size, pi)
            return pdf.assign(pi=pi, landed=[p in (0.0, 1.0) for p in pi])[[*names, "landed"]]

        done = staged(dealt.groupBy(*stratum, "blocks", "block").applyInPandas(run, schema), f"cube{level}")
        decided.append(done.filter("landed").drop("landed"))
        open_ = done.filter("not landed").drop("landed")
        if open_.isEmpty():
            break
        level += 1
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out.withColumnRenamed("pi", "chosen")


def mix(df: DataFrame, key: str = "doc_id", weights=WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """How often the mix takes each document.

    Returns one row a row of ``df`` (``key``, source, text): unit (long, a hash
    of the key), the key, size, source, source_size, target, rate and copies
    (long). A null source is a source of its own, last in order; null and empty
    texts have size 0 and take part as documents without words. Rows with equal
    keys are documents of their own, decided one by one; rows with a null key
    are spread by their place in the table. An empty table gives no rows.
    """
    taken = _taken(df.select(key, "source", "text"), key, weights, most, block)
    return taken.select("unit", key, "size", "source", "source_size", "target", "rate", "copies")


def _taken(df: DataFrame, key: str, weights=WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """The columns of mix and those of ``df`` besides its text."""
    sized = with_size(df).drop("text")
    unit = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(key))
    sized = staged(sized.withColumn("unit", unit), "sizes")
    rates = staged(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "rates")
    # a source is a hot key, but the table of sources is joined to it, not shuffled against itself: AQE splits it
    rated = sized.join(rates.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    draw = F.pmod(F.xxhash64(key, "size", F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)
    rated = (rated.withColumn("sure", F.floor(F.col("rate") + EPS))
             .withColumn("pi", F.greatest(F.col("rate") - F.col("sure"), F.lit(0.0))).withColumn("draw", draw))
    chosen = choose(rated, ["source"], block)
    return chosen.withColumn("copies", (F.col("sure") + F.col("chosen")).cast("long"))


def mixed(df: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The mix itself: every row of ``df``, as often as it is taken (0 times: not at all).

    The copies are those that mix decides, row by row: of rows that share a key
    and a size the order of a hash of their content decides.
    """
    rows = staged(df.select(F.monotonically_increasing_id().alias("_at"), F.xxhash64(*[F.col(c) for c in df.columns]).alias("_content"), F.struct(*df.columns).alias("_row")), "rows")
    one = F.col("_row")
    taken = _taken(rows.select(one[key].alias("_key"), one["source"].alias("source"), one["text"].alias("text"), "_at", "_content"), "_key", **options)
    out = rows.join(taken.filter("copies > 0").select("_at", "copies"), "_at")
    return out.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")
