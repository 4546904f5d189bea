"""Shared helpers: shipping the package, tables in the shared folder, streams of groups."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airdata.session import checkpoint_dir

#: Applications whose Python workers have this package already.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application.

    Workers import it by name, so what they cache (vocabularies, models)
    lives as long as the worker and not as long as one task.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="airdata-"), "airdata.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names in spark.checkpoint.dir."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and return a scan of it.

    Cuts the lineage: what follows survives the loss of an executor without
    computing df again, and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions are evaluated once a row.

    Plain projections are merged into what uses them, and filters are pushed
    below them, with a copy of the expression at every use; for expressions over
    whole texts that multiplies the work. A generator of one row is not merged.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.drop(*columns).select("*", F.inline(F.array(made)))


#: A key is heavy from this part of all rows on; there are fewer than HEAVY such keys.
HEAVY = 1000


def heavy_join(left: DataFrame, right: DataFrame, on: list[str], size: str, how: str = "inner") -> DataFrame:
    """Join left with right, which is unique in ``on`` and holds in ``size`` the rows of left by key.

    The heavy keys of right, fewer than HEAVY by the sum of their sizes, are
    broadcast, and their rows of left stay where they are; only the others are
    shuffled. ``how``: inner or left. Both sides should be tables: they are read twice.
    """
    total = right.agg(F.sum(size)).scalar()
    is_heavy = F.col(size) * HEAVY > total
    heavy = right.filter(is_heavy)  # fewer than HEAVY rows
    rest = left.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(right.filter(~is_heavy), on, how)
    return left.join(F.broadcast(heavy), on).unionByName(rest)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column; null stays null."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The runs of equal keys of a partition sorted by them, one table a run.

    Only the run at the end of a batch waits for the next batch, so memory
    follows the largest run and not the partition.
    """
    held: list[pa.RecordBatch] = []
    last = None

    def flush():
        return pa.Table.from_batches(held)

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*cols))
        start = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield flush()
                    held = []
                start, last = i, key
        held.append(batch.slice(start))
    if held:
        yield flush()
