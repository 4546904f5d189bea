"""Nearest neighbours by a permutation index.

A bounded set of pivots, distinct vectors chosen by hash, sees every vector: the
order of the pivots by their distance is the vector's permutation. A vector is
posted in the inverted files of its ``POSTS`` nearest pivots. A query looks into
the files of its ``PROBES`` nearest pivots, ranks what it finds there by the
footrule distance of the permutations (the sum of the differences in rank), and
reranks the best ``SHARE`` by the true distance.

Files are dealt into blocks, and so are the queries of a file, so that neither a
pivot that is near to a large part of all vectors nor a large number of queries
meets in one task. All vectors are indexed and nothing but ranks is dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airdata.llm.common import groups, ship, staged

PIVOTS, POSTS, PROBES = 64, 4, 24
#: Part of a block that is reranked, and the least number.
SHARE, LEAST = 0.3, 64
#: Vectors and queries of a file that one task compares at a time.
BLOCK, QUERIES = 4096, 1024


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key, vector (array<double>) of the rows that take part.

    Left out: null keys, null, empty and zero vectors, vectors with a null or
    non-finite component, and vectors of another dimension than most rows have.
    """
    d = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    d = d.filter("key is not null and size(vector) > 0")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    d = d.filter(~odd).filter(F.exists("vector", lambda x: x != 0))
    sizes = d.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    return d.filter(F.size("vector") == sizes.select("n").scalar())


def choose_pivots(vectors: DataFrame, most: int = PIVOTS) -> np.ndarray:
    """Up to ``most`` distinct vectors, those with the smallest hashes; one for four distinct vectors where there are few."""
    print_ = F.xxhash64("vector")
    one = staged(vectors.groupBy(print_.alias("print")).agg(F.min("key").alias("key")), "prints")
    few = one.orderBy("print").limit(4 * most)
    keys = [r["key"] for r in few.collect()]  # 4 * most rows at most
    keys = keys[:min(most, -(-len(keys) // 4))]
    rows = vectors.filter(F.col("key").isin(keys)).groupBy(print_).agg(F.first("vector").alias("v")).orderBy(print_).limit(most).collect()
    return np.array([r["v"] for r in rows], np.float64)


def permutations(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For each row of x the pivots from the nearest on (ties by number)."""
    d = (pivots**2).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.argsort(d, axis=1, kind="stable")


def ranks(order: np.ndarray) -> np.ndarray:
    """Place of each pivot in the permutations."""
    out = np.empty(order.shape, np.int16)
    np.put_along_axis(out, order, np.arange(order.shape[1], dtype=np.int16)[None, :].repeat(len(order), 0), 1)
    return out


def post(vectors: DataFrame, pivots: np.ndarray, depth: int) -> DataFrame:
    """A row for each vector and each of its ``depth`` nearest pivots: pivot, key, vector (binary, doubles)."""

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 2048):
                part = b.slice(k, 2048)
                if not part.num_rows:
                    continue
                x = np.array(part.column("vector").to_pylist(), np.float64)
                near = permutations(x, pivots)[:, :depth]
                n = near.shape[1]
                rows = [v.tobytes() for v in x]
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel().astype(np.int32)), part.column("key").take(pa.array(np.repeat(np.arange(len(x)), n))),
                                                  pa.array([v for v in rows for _ in range(n)], pa.binary())], ["pivot", "key", "vector"])

    return vectors.mapInArrow(run, "pivot int, key long, vector binary")


def nearest(found: np.ndarray, keys: np.ndarray, query: np.ndarray, own: int, far: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rerank one query: the k nearest keys and their distances, among the best SHARE by footrule."""
    n = max(LEAST, int(np.ceil(SHARE * len(keys)))) + 1
    if n < len(keys):  # ties in footrule go to the smaller keys
        cut = np.partition(far, n - 1)[n - 1]
        sure, tied = np.flatnonzero(far < cut), np.flatnonzero(far == cut)
        tied = tied[np.argsort(keys[tied], kind="stable")][:n - len(sure)]
        best = np.concatenate([sure, tied])
    else:
        best = np.arange(len(keys))
    best = best[keys[best] != own]
    d = np.sqrt(((found[best] - query) ** 2).sum(1))
    o = np.lexsort((keys[best], d))[:k]
    return keys[best][o], d[o]


def search(df: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest rows of df to each query, its own row left out.

    ``queries`` has the columns of df. Returns query_id, rank (int, from 1), the
    key as long and score (Euclidean distance, double), nearest first, ties to
    the smaller key. Rows that can't take part (see ``usable``) neither ask nor
    answer; rows with equal keys count as one neighbour, at their least
    distance; empty tables give no rows.
    """
    spark = df.sparkSession
    ship(spark)
    vectors = staged(usable(df, key, vector), "vectors")
    asked = usable(queries, key, vector)
    pivots = choose_pivots(vectors)
    if not len(pivots):
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    posted = staged(post(vectors, pivots, POSTS), "posts")
    probes = staged(post(asked, pivots, PROBES), "probes")

    def blocks(rows, size):  # a number for each pivot
        n = {r["pivot"]: -(-r["count"] // size) for r in rows.groupBy("pivot").count().collect()}
        return F.element_at(F.array(*[F.lit(n.get(p, 0)) for p in range(len(pivots))]), F.col("pivot") + 1)

    of_data, of_queries = blocks(posted, BLOCK), blocks(probes, QUERIES)

    def all_of(n):
        return F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)))

    mine = F.xxhash64("key")
    data = posted.withColumn("asking", all_of(of_queries)).withColumn("block", F.pmod(mine, of_data).cast("int")).withColumn("kind", F.lit(0))
    wants = probes.withColumn("block", all_of(of_data)).withColumn("asking", F.pmod(mine, of_queries).cast("int")).withColumn("kind", F.lit(1))
    both = data.unionByName(wants).repartition("pivot", "block", "asking").sortWithinPartitions("pivot", "block", "asking", "kind", "key")

    def run(batches):
        for g in groups(batches, "pivot", "block", "asking"):
            kind = g.column("kind").to_numpy()
            keys, n = g.column("key").to_numpy(), int((kind == 0).sum())
            x = np.frombuffer(b"".join(g.column("vector").to_pylist()), np.float64).reshape(len(keys), -1)
            if not n or n == len(keys):
                continue
            place = ranks(permutations(x, pivots))
            out = []
            for i in range(n, len(keys)):
                far = np.abs(place[:n] - place[i]).sum(1, dtype=np.int32)
                near, d = nearest(x[:n], keys[:n], x[i], keys[i], far, k)
                out.append((np.full(len(near), keys[i]), near, d))
            q, v, d = (np.concatenate(c) for c in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(d)], ["query_id", "key", "score"])

    found = both.select("pivot", "block", "asking", "kind", "key", "vector").mapInArrow(run, "query_id long, key long, score double")
    found = found.groupBy("query_id", "key").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "key")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("key").alias(key), "score")
