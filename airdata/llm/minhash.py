"""Near-duplicate documents by b-bit MinHash.

A document is the set of its word shingles. Its sketch holds, for each of
``BANDS * ROWS`` hash functions, the low ``BITS`` bits of the minimum, packed
into longs; the full minima of a band are hashed to one key. Documents with a
key in common are candidates. Their similarity is estimated from the packed
sketches by counting equal bit groups, corrected for groups that are equal by
chance, and pairs far below the threshold go. A second, finer sketch has the low
bits of the minima of ``BINS`` parts of one hash function's range; for a short
document that is nearly its whole set. All pairs left are confirmed on the full
shingle sets.

Groups of any size: documents with equal sets are one class, of which the
smallest id goes on. In every bucket all members are first compared with one
centre, the member that meets most others, a row a member, and components are
formed. Then only buckets that still hold several components are compared again,
and only across them, by blocks of members; a block confirms its links itself and
puts out no more of them than connect its components. So no connection is missed,
a group of n near copies costs about n comparisons and not n * n, and no step
makes more rows than it has members.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airdata.llm.common import groups, ship, staged, utf8

#: Words a shingle has; per cent of the union that two sets must share.
WORDS, PERCENT = 5, 80
#: 32 bands of 4 minima: at a similarity of 0.8 a pair shares no band once in 2e7.
BANDS, ROWS, BITS = 32, 4, 4
#: Parts of the range in the finer sketch, of 4 bits each: 0 for an empty part, else 1 to 15.
BINS, VALUES = 1024, 15
#: Standard deviations by which an estimate may lie below the threshold: a true pair is lost once in 3e6.
MARGIN = 5.0
#: Members of a bucket, and shingles of all of them, that one task compares at a time.
BLOCK, SHINGLES = 1024, 1 << 22

_SEED = 0x9E3779B97F4A7C15


class _Hashes(dict):
    """64-bit hash of a word; forgets everything when it gets large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= 400_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASH = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles: runs of ``words`` words, lower-cased A-Z.

    Fewer words make one shingle, the whole sequence; no words make none.
    """
    w = [] if text is None else text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASH.__getitem__, w), np.uint64, len(w))
    k = min(words, len(h))
    n = len(h) - k + 1
    with np.errstate(over="ignore"):
        x = np.full(n, np.uint64(_SEED + k))
        for i in range(k):
            x = _mixed(x ^ h[i:i + n]) + np.uint64(_SEED)
    return np.unique(x)


@functools.cache
def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    return r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 2**64, n, dtype=np.uint64)


def sketch(x: np.ndarray, bands: int = BANDS, rows: int = ROWS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (int64) and the packed low bits of the minima (int64) of a non-empty set of hashes."""
    a, b = _coefficients(bands * rows)
    with np.errstate(over="ignore"):
        least = np.full(len(a), np.uint64(2**64 - 1))
        for k in range(0, len(x), 512):  # the block of values stays in cache
            m = x[None, k:k + 512] * a[:, None]
            m += b[:, None]
            np.minimum(least, m.min(1), out=least)
        spread = _mixed(least)
        low = spread & np.uint64((1 << bits) - 1)
        keys = np.full(bands, np.uint64(_SEED))
        for i in range(rows):
            keys = _mixed(keys ^ least[i::rows]) + np.uint64(i)
        keys = _mixed(keys + np.arange(bands, dtype=np.uint64))
    per = 64 // bits
    packed = np.zeros(-(-len(low) // per), np.uint64)
    for i in range(len(low)):
        packed[i // per] |= low[i] << np.uint64(bits * (i % per))
    return keys.view(np.int64), packed.view(np.int64)


def fine_sketch(x: np.ndarray) -> bytes:
    """The finer sketch of a set of hashes: the low bits of the least hash of each part of the range, packed."""
    with np.errstate(over="ignore"):
        y = np.sort(_mixed(x ^ np.uint64(_SEED)))
    part = (y >> np.uint64(65 - BINS.bit_length())).astype(np.int64)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    low = np.zeros(BINS, np.uint8)
    low[part[first]] = 1 + (y[first] & np.uint64(0xFFFF)) % np.uint64(VALUES)
    return (low[::2] | low[1::2] << 4).tobytes()


def fine_similar(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: float, margin: float = MARGIN) -> np.ndarray:
    """Whether pairs of finer sketches (rows of uint64) may reach the threshold, by bit counts.

    Of the parts filled in either, the share of equal ones estimates the
    similarity, less what agrees by chance (1 in VALUES). Its variance shrinks
    with the part of the union that the sketch holds: sets smaller than BINS
    are held almost whole.
    """
    ones = np.uint64(0x1111111111111111)

    def filled(x):
        return (x | x >> np.uint64(1) | x >> np.uint64(2) | x >> np.uint64(3)) & ones

    def count(x):
        return np.bitwise_count(x).sum(1).astype(float)

    in_a, in_b = filled(a), filled(b)
    both, either = in_a & in_b, np.maximum(count(in_a | in_b), 1)
    equal, both = count(both & ~filled(a ^ b)), count(both)
    c, j = 1 / VALUES, percent / 100
    estimate = (equal - c * both) / (1 - c) / either
    held = np.clip(either * (1 + j) / np.maximum(n_a + n_b, 1), 0, 1)
    sigma = np.sqrt((j * (1 - j) * (1 - held) + c * (1 - j)) / either)
    return estimate >= j - margin * sigma - 1 / either


def floor_of(percent: float, n: int = BANDS * ROWS, bits: int = BITS, margin: float = MARGIN) -> int:
    """Least number of equal bit groups that keeps a pair as a candidate.

    Equal groups arise with probability C + (1 - C) J, where C = 2^-bits is
    the chance that different minima agree in their low bits.
    """
    c, j = 2.0**-bits, percent / 100
    p = c + (1 - c) * j
    return int(np.floor(n * p - margin * np.sqrt(n * p * (1 - p))))


def matches(a: Column, b: Column, longs: int = BANDS * ROWS * BITS // 64, bits: int = BITS) -> Column:
    """Number of equal bit groups of two packed sketches, by bit counts."""
    ones = int("".join(f"{1:0{bits}b}" for _ in range(64 // bits)), 2)
    total = F.lit(longs * (64 // bits))
    for i in range(longs):
        x = a[i].bitwiseXOR(b[i])
        y = x
        for s in range(1, bits):
            y = y.bitwiseOR(F.shiftrightunsigned(x, s))
        total = total - F.bit_count(y.bitwiseAND(F.lit(ones)))
    return total


def similarity(equal: Column, n: int = BANDS * ROWS, bits: int = BITS) -> Column:
    """The collision-corrected estimate of the similarity from the number of equal groups."""
    c = 2.0**-bits
    return F.greatest((equal / n - c) / (1 - c), F.lit(0.0))


def sketches(docs: DataFrame, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of docs: key, n_shingles, print (of the whole set; null if empty), keys, bits, fine."""
    ship(docs.sparkSession)
    schema = pa.schema([("n_shingles", pa.int64()), ("print", pa.binary()), ("keys", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())), ("fine", pa.binary())])

    def run(batches):
        import xxhash

        for b in batches:
            for k in range(0, b.num_rows, 500):
                part, out = b.slice(k, 500), []
                for t in utf8(part.column(text)):
                    x = shingles(t, words)
                    if len(x):
                        keys, bits = sketch(x)
                        out.append((len(x), xxhash.xxh3_128_digest(x.tobytes()), keys, bits, fine_sketch(x)))
                    else:
                        out.append((0, None, None, None, None))
                yield pa.RecordBatch.from_arrays([part.column(key), *(pa.array([r[i] for r in out], schema.field(i).type) for i in range(5))],
                                                 [key, *schema.names])

    return docs.select(key, text).mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, n_shingles long, print binary, keys array<long>, bits array<long>, fine binary")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (u, v) whose full sets share ``percent`` of their union; texts: rep, text."""
    t = (pairs.join(texts.select(F.col("rep").alias("u"), F.col("text").alias("text_u")), "u")
         .join(texts.select(F.col("rep").alias("v"), F.col("text").alias("text_v")), "v"))

    def run(batches):
        known: dict[bytes, np.ndarray] = {}  # the pairs come in the order of one end

        def set_of(t):
            if t not in known:
                if len(known) >= 64:
                    known.clear()
                known[t] = shingles(t, words)
            return known[t]

        for b in batches:
            ok = []
            for p, q in zip(utf8(b.column("text_u")), utf8(b.column("text_v"))):
                x, y = set_of(p), set_of(q)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v")], ["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return t.select("u", "v", "text_u", "text_v").mapInArrow(run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v): the smallest id it can reach.

    Alternating stars: every node hands the smallest id it knows first to its
    larger neighbours, then to its smaller ones, until nothing changes; a round
    roughly squares what a node sees. Each round is a table in the shared folder.
    """
    e = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # a table, so that the join below has two shuffled sides and AQE can split the links of a large star
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = staged(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        small = staged(small.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u > v").distinct(), "links")
        # stars only: every larger end has one link and no smaller end is itself a larger one
        if small.exceptAll(e).isEmpty() and e.exceptAll(small).isEmpty():
            break
        e = small
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _across(members: DataFrame, least: int, words: int, percent: int) -> DataFrame:
    """Links (u, v) that connect what is connected among the components of a bucket.

    members: key, rep, component, n, bits, fine, text, blocks (of the bucket).
    Every pair of blocks of a bucket is one group of rows, so no task holds a
    whole bucket. Inside a group the pairs across components that pass both
    sketches are confirmed on their full sets, those with most candidates first,
    and only while they still lie in different components. So a group puts out a
    spanning forest of its links, at most a row less than it has members.
    """
    dealt = (members.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "component", "n", "bits", "fine", "text"))

    def run(batches):
        for g in groups(batches, "key", "i", "j"):
            g = g.sort_by([("component", "ascending"), ("rep", "ascending")])
            rep, comp, n, mine, i, j = (g.column(c).to_numpy() for c in ("rep", "component", "n", "mine", "i", "j"))
            bits = np.stack(g.column("bits").to_pylist()).view(np.uint64)
            fine = np.frombuffer(b"".join(g.column("fine").to_pylist()), np.uint64).reshape(len(rep), -1)
            split, text, sets = i[0] != j[0], g.column("text"), {}
            near = np.zeros((len(rep), len(rep)), bool)
            first = np.searchsorted(comp, comp, "left")
            for k in np.flatnonzero(first > 0):  # against all of the components before its own
                to = slice(0, first[k])
                y = bits[to] ^ bits[k]
                x = y.copy()
                for s in range(1, BITS):
                    y |= x >> np.uint64(s)
                y &= np.uint64(int("".join(f"{1:0{BITS}b}" for _ in range(64 // BITS)), 2))
                equal = bits.shape[1] * (64 // BITS) - np.bitwise_count(y).sum(1).astype(int)
                ok = (equal >= least) & (100 * np.minimum(n[to], n[k]) >= percent * np.maximum(n[to], n[k]))
                if split:
                    ok &= mine[to] != mine[k]
                ok = np.flatnonzero(ok)
                ok = ok[fine_similar(fine[ok], fine[k:k + 1], n[ok], n[k], percent)]
                near[k, ok] = near[ok, k] = True

            def set_of(k):
                if k not in sets:
                    t = text[int(k)].as_py()
                    sets[k] = shingles(t.encode("utf-8", "replace") if isinstance(t, str) else t, words)
                return sets[k]

            out = []
            for k in np.argsort(-near.sum(1), kind="stable"):
                for v in np.flatnonzero(near[k] & (comp != comp[k])):
                    if comp[v] == comp[k]:  # connected in the meantime
                        continue
                    a, b = set_of(k), set_of(v)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        out.append((min(rep[k], rep[v]), max(rep[k], rep[v])))
                        comp = np.where(comp == comp[v], comp[k], comp)
                near[:, k] = False
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["u", "v"])

    sortable = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sortable.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Group the rows of ``docs`` by chains of near-duplicate links.

    Returns a row a row of docs: key, n_shingles (long), component_id (the
    smallest key reachable) and kept (key = component_id; of rows that share a
    key and a set one each is not told apart: all are kept). Null and empty
    texts have no shingles and are linked with nothing. Rows with a null key
    take part in no link: component_id is null and they are kept. An empty
    table gives no rows; other columns of docs play no part.
    """
    least = floor_of(percent)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    made = staged(sketches(docs, words), "sketches")
    sets = made.filter("n_shingles > 0 and doc_id is not null")
    # classes of equal sets; counted before the shuffle, so a set that a third of all documents have is a row a task
    class_ = staged(sets.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    # different rows may share an id: one sketch for each class, taken from its smallest id
    reps = staged(sets.join(class_, "print").filter("doc_id = rep").groupBy("print").agg(
        F.first("rep").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("bits").alias("bits"), F.first("fine").alias("fine"))
        .select("rep", "n", "keys", "bits", "fine"), "representatives")
    posts = reps.select("rep", F.explode("keys").alias("key"))

    size = staged(posts.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "sizes")
    shared = staged(posts.join(size, "key"), "buckets")
    # the centre of a bucket is the member that meets most others over all its buckets: of a group of near copies
    # the most typical one, which the others are nearest to, and mostly the same in all buckets of a group
    met = shared.groupBy("rep").agg(F.sum("size").alias("met"))
    centre = shared.join(met, "rep").groupBy("key").agg(F.max_by("rep", F.struct("met", -F.col("rep"))).alias("centre"))
    shared = staged(shared.select("key", "rep").join(centre, "key"), "centred")
    slim = reps.select("rep", "n", "bits")
    star = shared.filter("rep <> centre").select(F.least("rep", "centre").alias("u"), F.greatest("rep", "centre").alias("v")).distinct()
    star = (star.join(slim.toDF("u", "n_u", "bits_u"), "u").join(slim.toDF("v", "n_v", "bits_v"), "v")
            .filter(100 * F.least("n_u", "n_v") >= percent * F.greatest("n_u", "n_v"))
            .filter(matches(F.col("bits_u"), F.col("bits_v")) >= least).select("u", "v"))
    star = staged(star, "star")
    near = staged(shared.select(F.col("rep").alias("doc_id")).distinct(), "near")
    texts = staged(docs.filter("text is not null").join(near, "doc_id", "left_semi").withColumnRenamed("doc_id", "rep"), "texts")
    links = staged(confirmed(star, texts, words, percent), "confirmed")
    comp = components(links)

    # what lies in one bucket and in different components yet
    def labelled(c):
        return reps.select("rep", "n", "bits", "fine").join(c.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    label = staged(labelled(comp), "labels")
    posted = shared.select("key", "rep").join(label.select("rep", "component"), "rep")
    mixed = posted.join(label.select("rep", "n"), "rep").groupBy("key").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("size"), F.sum("n").alias("all"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("all") / SHINGLES)).cast("int")
    mixed = staged(mixed.filter("a <> b").select("key", blocks.alias("blocks")), "mixed")
    members = posted.join(mixed, "key").join(label.select("rep", "n", "bits", "fine"), "rep").join(texts, "rep")
    links = staged(links.unionByName(_across(members, least, words, percent)), "all-links")
    final = components(links).withColumnRenamed("node", "rep")

    found = class_.join(final, "rep", "left").select("print", F.coalesce("component", "rep").alias("component_id"))
    # a class that holds a third of all rows is a hot key of this join: AQE splits its other side
    out = made.select("doc_id", "n_shingles", "print").join(found, "print", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(own)
    return (out.select(F.col("doc_id").alias(key), F.col("n_shingles"), own.alias("component_id"))
            .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))))

