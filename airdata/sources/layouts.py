"""Delimited files whose layout differs from file to file, and a channel for lines that do not parse.

One header for a whole folder would be laid over every file, whatever the order
of its columns. Here each file's own first line counts: the first lines are read
by tasks, files are grouped by header, and every layout is one scan of its files.
A line that has too few or too many fields or a broken quote is not filled up
with nulls: it goes to the rejects with its file, place and reason, and so do all
lines of a file whose header fits no known layout.
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes in which a header must end.
HEADER_BYTES = 1 << 16
BAD = "_bad"
REJECTS = "file string, start long, position long, line string, reason string"


def string_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_ord``, the place of a row: file, start of its split, position in
    the split. Splits are packed into tasks by size, so the position alone
    would order rows by file size."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                  F.monotonically_increasing_id().alias("position"))
    return df.select(*df.columns, at.alias("_ord"))


def read_delimited(spark: SparkSession, files, names, header: str | None) -> DataFrame:
    """The lines of files of one layout as strings, with ``_ord`` and, for a line
    that does not fit the layout, the line itself in ``_bad``. ``header`` is the
    first line of each file, if it is no row. Lines are rows: no field holds a
    line feed. Blank lines are none."""
    lines = with_file_order(spark.read.text(files)).filter(F.trim("value") != "")
    if header is not None:
        lines = lines.filter((F.col("_ord.start") > 0) | ~F.startswith(F.col("value"), F.lit(header)))
    ddl = ", ".join(f"`{n}` string" for n in [*names, BAD])
    row = F.from_csv("value", ddl, {"escape": '"', "nullValue": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    return lines.select(row.alias("r"), "_ord").select("r.*", "_ord")


def reason_of(line: Column, fields: int) -> Column:
    """Why a line does not fit: its quotes, or the number of its fields."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "")
    n = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (F.when(F.contains(bare, F.lit('"')), "broken quotes").when(n < fields, "short row")
             .when(n > fields, "extra fields").otherwise("not a row"))


def parted(df: DataFrame, fields: int) -> tuple[DataFrame, DataFrame]:
    """Rows that fit (without ``_bad``), and the others as rejects."""
    bad = df.filter(F.col(BAD).isNotNull()).select("_ord.file", "_ord.start", "_ord.position", F.col(BAD).alias("line"), reason_of(F.col(BAD), fields).alias("reason"))
    return df.filter(F.col(BAD).isNull()).drop(BAD), bad


def first_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The first line of every file, read by tasks: no more than HEADER_BYTES a file."""

    def run(batches):
        import pyarrow as pa
        from pyarrow import fs
        for b in batches:
            out = []
            for path in b.column("file").to_pylist():
                system, at = fs.FileSystem.from_uri(path)
                with system.open_input_stream(at) as s:   # decompresses by the name
                    out.append(s.read(HEADER_BYTES).split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r"))
            yield pa.RecordBatch.from_arrays([b.column("file"), pa.array(out, pa.string())], ["file", "line"])

    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, min(len(files), 256)))
    return {r["file"]: r["line"] for r in listed.mapInArrow(run, "file string, line string").collect()}


def files_of(spark: SparkSession, path) -> list[str]:
    """The files under a path or paths, sub-folders included, as Spark lists them."""
    return sorted(spark.read.option("recursiveFileLookup", True).text(path).inputFiles())


def read_by_layout(spark: SparkSession, path, fit) -> tuple[DataFrame, DataFrame]:
    """The rows of all files, each read by its own header, and the rejects.

    ``fit`` takes the names of a header, normalised, and returns the columns to
    take, target -> name (None: the file has none, its rows get nulls), or None for a
    layout that it does not know. Rows have the target columns, as strings, and ``_ord``.
    """
    groups: dict[str, list[str]] = {}
    for f, line in first_lines(spark, files_of(spark, path)).items():
        groups.setdefault(line, []).append(f)
    rows, rejects = [], []
    for line, files in sorted(groups.items()):
        names = [n.strip().lower() for n in next(csv.reader([line]), [])]
        columns = fit(names) if len(set(names)) == len(names) else None
        if columns is None:
            text = with_file_order(spark.read.text(files)).filter((F.col("_ord.start") > 0) | (F.rtrim("value") != line.rstrip()))
            rejects.append(text.select("_ord.file", "_ord.start", "_ord.position", F.col("value").alias("line"), F.lit("unknown layout").alias("reason")))
            continue
        good, bad = parted(read_delimited(spark, files, names, line), len(names))
        taken = [(F.lit(None).cast("string") if n is None else F.col(f"`{n}`")).alias(c) for c, n in columns.items()]
        rows.append(good.select(*taken, "_ord"))
        rejects.append(bad)
    no_rejects = spark.createDataFrame([], REJECTS)
    if not rows:
        ord_ = T.StructType().add("file", T.StringType()).add("start", T.LongType()).add("position", T.LongType())
        rows = [spark.createDataFrame([], string_schema(fit(None)).add("_ord", ord_))]
    return reduce(DataFrame.unionByName, rows), reduce(DataFrame.unionByName, rejects, no_rejects)
