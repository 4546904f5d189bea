"""Best-fit packing of documents into sequences, after dominance reduction.

What decides a packing are the lengths of the pieces alone, and there are at
most ``capacity`` different ones. So the plan is made once, from the number of
pieces of each length, whatever the number of documents:

1. Reduction (Martello and Toth): for a piece, a set of at most three pieces
   with it that dominates every other set it could go into is made a sequence
   for good: some best packing has it. All pieces of a length are fixed in one
   step, as often as the lengths of the set allow. This repeats until nothing
   is dominated.
2. What is left is packed best-fit, longest first, again by length: all pieces
   of a length go into the fullest open sequences that take them.

The plan is a bounded list of runs: so many sequences of one make-up. The
pieces of a length are then numbered where they are, in salted groups, and each
number looks up its run, its sequence and its place.
"""

from __future__ import annotations

import bisect
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from airdata.llm.common import ship, staged, utf8
from airdata.llm.tokens import encoder

CAPACITY = 2048
#: Groups that the pieces of one length are numbered in.
SALTS = 1024


# ----------------------------------------------------------------- plan

def reduce_dominated(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sequences fixed for good, as (lengths, how many), and the counts left.

    For a piece of length w, with room r = capacity - w, where ``big`` is the
    longest other piece that fits, ``a`` and ``b`` (a >= b) the pair of others
    with the largest sum that fits:

    - nothing fits, or only one piece at a time does, or ``big`` fills the room:
      {w, big} dominates, for every set with w has one piece of at most big
      besides, or leaves no less room;
    - two fit at most and big >= a + b: {w, big}, for big stands for both;
    - two fit at most, a = big, and no pair that fits has both pieces longer
      than b: {w, a, b}, for the longer of any pair is at most a and the other
      at most b.
    """
    left = {w: n for w, n in counts.items() if n > 0 and w > 0}
    fixed: Counter = Counter()
    changed = True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while left.get(w):
                found = _dominating(w, left, capacity)
                if found is None:
                    break
                need = Counter(found)
                times = min(left[x] // k for x, k in need.items())
                fixed[found] += times
                for x, k in need.items():
                    left[x] -= k * times
                    if not left[x]:
                        del left[x]
                changed = True
    return list(fixed.items()), left


def _dominating(w: int, left: dict[int, int], capacity: int) -> tuple[int, ...] | None:
    """The dominating set of a piece of length w, longest first, or None."""
    room = capacity - w
    others = dict(left)
    others[w] -= 1
    if not others[w]:
        del others[w]
    lengths = sorted(others)
    if not lengths or lengths[0] > room:
        return (w,)
    big = lengths[bisect.bisect_right(lengths, room) - 1]
    smallest: list[int] = []
    for x in lengths:
        smallest += [x] * min(3, others[x])
        if len(smallest) >= 3:
            break
    fit = next((k for k in range(len(smallest), 0, -1) if sum(smallest[:k]) <= room), 0)
    if fit == 1 or big == room:
        return tuple(sorted((w, big), reverse=True))
    if fit != 2:
        return None
    best, pair, even = -1, None, 0
    for x in lengths:
        if x > room - lengths[0]:
            break
        # the longest partner that fits, one of two equal ones only if there are two
        k = bisect.bisect_right(lengths, room - x) - 1
        while k >= 0 and lengths[k] == x and others[x] < 2:
            k -= 1
        if k < 0:
            continue
        y = lengths[k]
        if x + y > best:
            best, pair = x + y, (max(x, y), min(x, y))
        even = max(even, min(x, y))
    if pair is None:
        return tuple(sorted((w, big), reverse=True))
    a, b = pair
    if big >= a + b:
        return tuple(sorted((w, big), reverse=True))
    if a == big and even <= b:
        return tuple(sorted((w, a, b), reverse=True))
    return None


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit, longest first, by length: sequences as (runs of (length, times), how many)."""
    open_: dict[int, Counter] = defaultdict(Counter)  # room -> make-up -> sequences
    rooms: list[int] = []

    def put(room, runs, n):
        if room not in open_ or not open_[room]:
            i = bisect.bisect_left(rooms, room)
            if i == len(rooms) or rooms[i] != room:
                rooms.insert(i, room)
        open_[room][runs] += n

    for w in sorted((w for w, n in counts.items() if n), reverse=True):
        n = counts[w]
        while n:
            i = bisect.bisect_left(rooms, w)
            if i == len(rooms):
                room, runs, m = capacity, (), -(-n // (capacity // w))
            else:
                room = rooms[i]
                runs, m = open_[room].popitem()
                if not open_[room]:
                    rooms.pop(i)
            times = min(room // w, n)
            full = min(m, n // times)
            put(room - times * w, (*runs, (w, times)), full)
            n -= full * times
            m -= full
            if n and n < times and m:  # the last one takes what is left
                put(room - n * w, (*runs, (w, n)), 1)
                n, m = 0, m - 1
            if m and runs:
                put(room, runs, m)
    return [(runs, n) for by in open_.values() for runs, n in by.items() if n]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[dict]:
    """The runs of the packing: length, first and last+1 number among the pieces of that length, sequence, times, offset.

    The piece with number k of a run is in sequence ``sequence + (k - first) //
    times``, at ``offset + (k - first) % times * length``.
    """
    fixed, left = reduce_dominated(counts, capacity)
    made = [(tuple(Counter(lengths).items()), n) for lengths, n in sorted(fixed, reverse=True)]
    made += sorted(best_fit(left, capacity), reverse=True)
    used: Counter = Counter()
    runs, sequence = [], 0
    for make_up, n in made:
        offset = 0
        for length, times in make_up:
            runs.append({"length": length, "first": used[length], "last": used[length] + n * times, "sequence": sequence, "times": times, "offset": offset})
            used[length] += n * times
            offset += length * times
        sequence += n
    return runs


# ------------------------------------------------------------ operators

def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The ids of every text, closed by ``end_id`` and cut to the capacity: key, piece, start, length, ids (binary, little-endian unsigned 32-bit).

    Only a text with more ids than the capacity is cut; its first piece takes
    the remainder, the others are full. A null text is an empty one: one piece
    with the end id.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part, rows = b.slice(k, 256), []
                for i, t in enumerate(utf8(part.column(text))):
                    ids = enc.encode(t) + end
                    n = len(ids) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                    rows += [(i, p, s, e - s, ids[4 * s:4 * e]) for p, (s, e) in enumerate(zip(cuts, cuts[1:]))]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([part.column(key).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                                                  pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary())], [key, "piece", "start", "length", "ids"])

    return docs.select(key, text).mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset (long) to every piece; other columns go along.

    ``pieces`` needs ``length``, from 1 to the capacity, and the columns in
    ``order``, which number the pieces of a length. Sequences are gapless from
    offset 0 on. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    ship(spark)
    # every length is dealt into salted groups, as one may hold a third of all pieces
    pieces = staged(pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int")), "pieces")
    counts = staged(pieces.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # capacity rows at most
    if any(x < 1 or x > capacity for x in by_length):
        raise ValueError("lengths must be from 1 to the capacity")
    runs = sorted(plan(by_length, capacity), key=lambda r: (r["length"], r["first"]))
    first = np.array([(r["length"] << 48) + r["first"] for r in runs], np.int64)
    of = {c: np.array([r[c] for r in runs], np.int64) for c in ("length", "first", "sequence", "times", "offset")}

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("length", "_salt").orderBy(*order)
    numbered = pieces.withColumn("_own", F.row_number().over(own)).join(starts, ["length", "_salt"])
    names = [c for c in pieces.columns if c != "_salt"]
    schema = T.StructType([*(f for f in pieces.schema.fields if f.name in names), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        for b in batches:
            length, k = (b.column(c).to_numpy() for c in ("length", "_number"))
            i = np.searchsorted(first, (length << 48) + k, "right") - 1
            k = k - of["first"][i]
            sequence, offset = of["sequence"][i] + k // of["times"][i], of["offset"][i] + k % of["times"][i] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return numbered.select(*names, (F.col("_before") + F.col("_own") - 1).alias("_number")).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """The packed pieces of all texts with their ids: doc_id, piece, start, length, ids, sequence_id, offset.

    Null and repeated ids are documents like any other.
    """
    return pack(token_pieces(docs, vocabulary, end_id, capacity), capacity, ("doc_id", "piece", "ids"))
