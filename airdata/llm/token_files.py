"""Token ids in Arrow stream files of equal-length sequences.

A shard is an Arrow stream file whose record batches hold two columns: ``ids``,
a fixed-size list of unsigned integers (of the narrowest width that holds the
vocabulary), and ``mask``, a fixed-size list of booleans that tells ids from
padding. All batches but the last have the same number of sequences and nothing
is compressed, so a memory-mapped file gives any sequence and its mask as a
view, without reading or copying others. A second stream file beside it lists
the documents with their place: doc_id, start, n_tokens.

Documents lie in ascending order of their id. They are dealt into shards by
range; a document never crosses shards, only sequences, and the last sequence
of a shard is padded.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from airdata.llm.common import shared_path, ship, staged, utf8
from airdata.llm.tokens import encoder

#: Ids a sequence has, sequences a batch has.
LENGTH, SEQUENCES = 2048, 128
#: Characters of text a shard holds about.
SHARD_CHARS = 24_000_000


def narrowest(size: int) -> np.dtype:
    """The narrowest unsigned type for the ids of a vocabulary."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


class ShardWriter:
    """One shard being written: whole batches go out as they fill, so memory holds one batch and the list of documents."""

    def __init__(self, path: str, kind: np.dtype, length: int = LENGTH, sequences: int = SEQUENCES):
        self.fs, self.base = pafs.FileSystem.from_uri(path)
        self.fs.create_dir(self.base, recursive=True)
        self.path, self.name = path.rstrip("/"), f"shard-{uuid.uuid4().hex}"
        self.kind, self.length, self.room = kind, length, length * sequences
        value = pa.from_numpy_dtype(kind)
        self.schema = pa.schema([("ids", pa.list_(value, length)), ("mask", pa.list_(pa.bool_(), length))], {"length": str(length), "sequences": str(sequences)})
        self.out = self.fs.open_output_stream(f"{self.base}/{self.name}.arrows")
        self.stream = pa.ipc.new_stream(self.out, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.total = self.last = 0
        self.docs: list[tuple] = []
        self.least = None

    def add(self, doc_id, ids: np.ndarray) -> None:
        self.docs.append((doc_id, self.total, len(ids)))
        self.total += len(ids)
        self.held.append(ids.astype(self.kind))
        self.n_held += len(ids)
        if self.n_held >= self.room:
            self._flush(self.n_held // self.room * self.room)

    def _flush(self, n: int) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.kind)
        for k in range(0, n, self.room):
            self._batch(flat[k:min(k + self.room, n)])
        self.held, self.n_held = [flat[n:].copy()], len(flat) - n

    def _batch(self, ids: np.ndarray) -> None:
        n = len(ids)
        pad = -n % self.length
        mask = np.ones(n + pad, bool)
        mask[n:] = False
        ids = np.concatenate([ids, np.zeros(pad, self.kind)]) if pad else ids
        self.stream.write_batch(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                                                 pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> dict:
        if self.n_held:
            self._flush(self.n_held)
        self.stream.close()
        self.out.close()
        with self.fs.open_output_stream(f"{self.base}/{self.name}.docs.arrows") as out:
            t = pa.table({"doc_id": pa.array([d[0] for d in self.docs], pa.int64()), "start": pa.array([d[1] for d in self.docs], pa.int64()),
                          "n_tokens": pa.array([d[2] for d in self.docs], pa.int64())})
            with pa.ipc.new_stream(out, t.schema) as w:
                w.write_table(t, max_chunksize=1 << 16)
        first = next((d[0] for d in self.docs if d[0] is not None), None)
        return {"path": f"{self.path}/{self.name}", "first_id": first, "tokens": self.total, "documents": len(self.docs)}


class Shard:
    """Random access to the sequences of a shard file: views of a memory map where the file is local."""

    def __init__(self, path: str):
        fs, at = pafs.FileSystem.from_uri(f"{path}.arrows")
        source = pa.memory_map(at) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(at)
        self.stream = pa.ipc.open_stream(source)
        self.length = int(self.stream.schema.metadata[b"length"])
        self.sequences = int(self.stream.schema.metadata[b"sequences"])
        self.batches: list[pa.RecordBatch] = []

    def _batch(self, k: int) -> pa.RecordBatch:
        while len(self.batches) <= k:  # a view each: reading on costs the header only
            self.batches.append(self.stream.read_next_batch())
        return self.batches[k]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence ``i``."""
        b, k = self._batch(i // self.sequences), i % self.sequences
        return b.column("ids")[k].values.to_numpy(), b.column("mask")[k].values.to_numpy(zero_copy_only=False)

    def span(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` on, across sequences and batches."""
        per, out = self.sequences * self.length, []
        while n:
            k, at = divmod(start, per)
            flat = self._batch(k).column("ids").flatten().to_numpy()
            part = flat[at:at + n]
            out.append(part)
            start, n = start + len(part), n - len(part)
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.empty(0, np.uint16)


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None, key: str = "doc_id", text: str = "text",
                      length: int = LENGTH, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Write the ids of all texts, each closed by ``end_id``, in ascending order of the key.

    Returns the list of shards, in the shared folder, too: path (without
    ending), start (ids before the shard), tokens, documents. Texts are dealt
    by ranges of the key into shards of about ``shard_chars`` characters and
    encoded there, so no id is shuffled. A null text is an empty one; null keys
    come first; rows with equal keys are ordered by text. An empty table gives
    no shards. A task that runs again writes files of other names, and only
    the listed ones count.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or shared_path(spark, "tokens")
    docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches):
        enc, writer = encoder(vocabulary), None
        end = np.array([end_id], "<u4").tobytes()
        kind = narrowest(max(enc.size, end_id + 1))
        for b in batches:
            for doc_id, t in zip(b.column("doc_id").to_pylist(), utf8(b.column("text"))):
                if writer is None:
                    writer = ShardWriter(path, kind, length)
                writer.add(doc_id, np.frombuffer(enc.encode(t) + end, "<u4"))
        if writer is not None:
            yield pa.RecordBatch.from_pylist([writer.close()], schema=pa.schema([("path", pa.string()), ("first_id", pa.int64()), ("tokens", pa.int64()), ("documents", pa.int64())]))

    shards = max(1, -(-total // shard_chars))
    # equal keys could be cut by the range, so the text orders them, too
    dealt = docs.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    made = staged(dealt.mapInArrow(run, "path string, first_id long, tokens long, documents long"), "shards")
    # a row a shard: one in about SHARD_CHARS characters
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    return made.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"), "tokens", "documents")


def read_token_files(spark: SparkSession, shards: DataFrame, ids: bool = True) -> DataFrame:
    """The documents of the shards, read back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, on demand, ids."""
    ship(spark)
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if ids else [])
    schema = pa.schema(fields)

    def run(batches):
        for b in batches:
            for path, before in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                shard = Shard(path)
                fs, at = pafs.FileSystem.from_uri(f"{path}.docs.arrows")
                with fs.open_input_stream(at) as f:
                    for part in pa.ipc.open_stream(f):
                        for k in range(0, part.num_rows, 512):
                            rows = []
                            for doc_id, start, n in zip(*(part.column(c)[k:k + 512].to_pylist() for c in ("doc_id", "start", "n_tokens"))):
                                x = shard.span(start, n).astype("<u4")
                                rows.append((doc_id, before + start, n, zlib.crc32(x.tobytes()), x.astype("<i4")))
                            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], schema.field(i).type) for i in range(len(fields))], schema=schema)

    ddl = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return shards.select("path", "start").repartition(spark.sparkContext.defaultParallelism, "path").mapInArrow(run, ddl)
