"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: it starts at an offset and goes on by a skip, both hashes of its name, so
the order is a permutation of all slots. The shards take turns, each claiming
the next free slot of its order, until the table is full. Shares then differ by
one slot at most, and adding or taking away a shard moves few slots besides the
ones it must. A row goes to the shard of the slot its key hashes to: one array
access in a native expression. The table depends on the shards alone, never on
the rows, so its size (``slots``) bounds what is sent to the executors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of the table; a prime, well over 100 slots a shard.
SLOTS = 65_537


def _number(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The table: for each slot, the index of its shard in the order of names given."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be a list of distinct names, at least one")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("slots must be a prime and no less than the number of shards")
    place = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    out = [-1] * slots
    left = slots
    while left:
        for k in range(len(shards)):
            while out[place[k]] >= 0:
                place[k] = (place[k] + skip[k]) % slots
            out[place[k]] = k
            left -= 1
            if not left:
                break
    return out


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of its MD5, modulo the table size."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long") % slots


def key_of(*columns: str) -> Column:
    """One text out of the key columns; a null differs from every text, also from an empty one."""
    parts = [F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col(c).cast("string"))) for c in columns]
    return F.concat_ws("\x1f", *parts)


def assign_shards(df: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS,
                  spread: list[str] | None = None, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """Add ``slot`` (long) and ``shard`` (string) to every row of df.

    Rows with equal keys share a shard. ``spread`` names further columns that
    are hashed with the key, so that a key with a large part of the rows is
    dealt over the shards. No row moves: there is no shuffle.

    Null keys are a key of their own; empty tables give empty results; columns
    of df with the names of the new ones are replaced.
    """
    at = slot_of(key_of(*keys, *(spread or [])), slots)
    # a literal once folded: constant-time access, sent along with the tasks
    lookup = F.split(F.lit(",".join(map(str, fill(shards, slots)))), ",")
    names = F.split(F.lit(",".join(shards)), ",")
    if any("," in s for s in shards):
        raise ValueError("names of shards must not contain a comma")
    return (df.withColumn(slot, at)
            .withColumn(shard, F.get(names, F.get(lookup, F.col(slot).cast("int")).cast("int"))))


def write_shards(df: DataFrame, path: str, shard: str = "shard", files_per_shard: int = 8) -> None:
    """Write one folder a shard; each shard is written by ``files_per_shard`` tasks."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_shard))
    df.repartition(F.col(shard), salt).write.partitionBy(shard).parquet(path)
