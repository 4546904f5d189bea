"""Sinks (W-01, W-02, W-04): tables whose content is what their manifest says.

A plain folder of Parquet files has no transaction: a write that dies leaves
half its files, and one that is run again leaves them twice. A table here is a
folder with ``data/write=<name>/`` folders and numbered manifests. A write puts its
files into a folder of its own, then creates the next manifest, exclusively, in
one small write. Readers take the files of the last whole manifest and nothing
else. Each write names itself by a key that the manifest keeps, so a write that
is repeated changes nothing. Old versions stay readable, and nothing that a plan
reads is ever overwritten.

Paths are URIs and stay as they are; the session's Hadoop configuration opens
them, whatever their scheme.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """W-01: CSV with a header, no index (a directory of part files)."""
    df.write.mode(mode).option("header", True).csv(path)


class ConcurrentWrite(RuntimeError):
    """Another write took the next version again and again."""


@dataclass(frozen=True)
class Manifest:
    """A version of a table: its data folders (relative), the keys of the writes behind it, its schema."""
    version: int
    folders: tuple[str, ...]
    keys: tuple[str, ...]
    schema: str | None


EMPTY = Manifest(0, (), (), None)


def join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


class _Folder:
    """The manifest folder of a table, through the session's Hadoop file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(join(root, "_manifests"))
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self.fs.exists(self.path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.jvm.org.apache.hadoop.fs.Path(self.path, name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Create a file that must not be there; False if it is."""
        at = self.jvm.org.apache.hadoop.fs.Path(self.path, name)
        try:
            stream = self.fs.create(at, False)
        except Py4JJavaError as e:
            if self.fs.exists(at):
                return False
            raise e
        stream.write(bytearray(text.encode()))
        stream.close()
        return True


def _parsed(text: str) -> Manifest | None:
    """A manifest, or None for one whose write did not end."""
    try:
        m = json.loads(text)
        return Manifest(m["version"], tuple(m["folders"]), tuple(m["keys"]), m["schema"])
    except (ValueError, KeyError):
        return None


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The last whole manifest, or that of ``version``; EMPTY before the first write."""
    folder = _Folder(spark, root)
    names = [f"v{version:010d}.json"] if version is not None else reversed(folder.names())
    for name in names:
        if name.startswith("v") and (m := _parsed(folder.read(name))):
            return m
    return EMPTY


def _next_name(folder: _Folder) -> str:
    last = max((int(n[1:11]) for n in folder.names() if n.startswith("v")), default=0)
    return f"v{last + 1:010d}.json"


def _commit(df: DataFrame, root: str, key: str | None, partition_by, keep: bool) -> Manifest:
    spark, key = df.sparkSession, key or uuid.uuid4().hex
    now = manifest(spark, root)
    if key in now.keys:
        return now
    folder = f"data/write={uuid.uuid4().hex}"   # named like a partition, so that partitions of several writes go together
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(join(root, folder))
    at = _Folder(spark, root)
    for _ in range(20):
        now = manifest(spark, root)
        if key in now.keys:   # the same write ended elsewhere in the meantime
            return now
        name = _next_name(at)
        new = Manifest(int(name[1:11]), (*now.folders, folder) if keep else (folder,), (*now.keys, key), df.schema.json())
        if at.create(name, json.dumps(new.__dict__)):
            return new
    raise ConcurrentWrite(root)


def append_table(df: DataFrame, root: str, key: str | None = None, partition_by=None) -> Manifest:
    """W-02: add rows to the table at ``root``, all or none of them (partitioned, if
    wished, e.g. facts by year and month, so that scans prune). A write with a
    ``key`` that the table has already changes nothing."""
    return _commit(df, root, key, partition_by, keep=True)


def rewrite_table(df: DataFrame, root: str, key: str | None = None, partition_by=None) -> Manifest:
    """W-04: replace the content of the table at ``root`` by ``df``, which may read
    the table itself: the version it reads stays as it is."""
    return _commit(df, root, key, partition_by, keep=False)


def read_table(spark: SparkSession, root: str, schema=None, version: int | None = None) -> DataFrame:
    """The rows of the last version, or of ``version``. ``schema`` is that of a table
    that has not been written yet."""
    m = manifest(spark, root, version)
    if not m.folders:
        if schema is None:
            raise FileNotFoundError(f"no version of a table at {root}")
        return spark.createDataFrame([], schema)
    from pyspark.sql.types import StructType
    of = StructType.fromJson(json.loads(m.schema))
    return spark.read.schema(of).option("basePath", join(root, "data")).parquet(*[join(root, f) for f in m.folders]).select(*of.names)
