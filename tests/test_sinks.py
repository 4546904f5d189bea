"""Committed tables: writes that die, are repeated, race or read what they replace."""

import os

import pytest
from pyspark.sql import functions as F

from airdata.sources import sinks as W


def ids(spark, root, **kw):
    return sorted(r.id for r in W.read_table(spark, root, **kw).collect())


def test_csv_round_trip(spark, tmp_dir):
    W.write_csv(spark.range(5), os.path.join(tmp_dir, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(tmp_dir, "csv")).count() == 5


def test_append_and_rewrite(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    with pytest.raises(FileNotFoundError):
        W.read_table(spark, root)
    assert W.read_table(spark, root, "id long").count() == 0
    W.append_table(spark.range(3), root)
    W.append_table(spark.range(3, 5), root)
    assert ids(spark, root) == [0, 1, 2, 3, 4]
    W.rewrite_table(W.read_table(spark, root).filter("id > 1"), root)   # reads what it replaces
    assert ids(spark, root) == [2, 3, 4] and ids(spark, root, version=2) == [0, 1, 2, 3, 4]


def test_a_repeated_write_changes_nothing(spark, tmp_dir):
    root = "file://" + os.path.join(tmp_dir, "t")   # a URI stays one
    for _ in range(3):
        W.append_table(spark.range(3), root, key="load-1")
    first = W.manifest(spark, root)
    assert ids(spark, root) == [0, 1, 2] and first.version == 1 and len(first.folders) == 1
    W.rewrite_table(spark.range(9), root, key="clean-1")
    W.append_table(spark.range(3), root, key="load-1")
    W.rewrite_table(spark.range(1), root, key="clean-1")
    assert len(ids(spark, root)) == 9


def test_a_write_that_dies_leaves_nothing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    W.append_table(spark.range(3), root, key="a")
    # half of its files are there, its manifest is not
    spark.range(100).write.parquet(W.join(root, "data", "write=dead"))
    assert ids(spark, root) == [0, 1, 2]
    # it died while its manifest was written
    with open(os.path.join(root, "_manifests", "v0000000002.json"), "w") as f:
        f.write('{"version": 2, "folders": ["data/write=de')
    assert ids(spark, root) == [0, 1, 2]
    W.append_table(spark.range(3, 5), root, key="b")
    assert ids(spark, root) == [0, 1, 2, 3, 4] and W.manifest(spark, root).version == 3
    with pytest.raises(Exception):
        W.append_table(spark.range(3).select(F.raise_error(F.lit("dies")).cast("long").alias("id")), root, key="c")
    assert ids(spark, root) == [0, 1, 2, 3, 4] and "c" not in W.manifest(spark, root).keys


def test_a_race_loses_no_write(spark, tmp_dir, monkeypatch):
    root, real, first = os.path.join(tmp_dir, "t"), W._Folder.create, []

    def beaten(self, name, text):
        if not first:   # another write takes the version between reading and creating
            first.append(name)
            W.append_table(spark.range(10, 12), root, key="other")
        return real(self, name, text)

    monkeypatch.setattr(W._Folder, "create", beaten)
    W.append_table(spark.range(3), root, key="mine")
    assert ids(spark, root) == [0, 1, 2, 10, 11] and W.manifest(spark, root).keys == ("other", "mine")


def test_partitions_over_several_writes_prune(spark, tmp_dir):
    root = os.path.join(tmp_dir, "t")
    rows = spark.createDataFrame([(2023, 1, 1), (2024, 2, 2)], "year int, month int, v int")
    W.append_table(rows, root, "a", ["year", "month"])
    W.append_table(rows.withColumn("v", F.col("v") + 10), root, "b", ["year", "month"])
    t = W.read_table(spark, root)
    assert t.columns == ["year", "month", "v"]
    some = t.filter("year = 2024")
    assert sorted(r.v for r in some.collect()) == [2, 12]
    assert "PartitionFilters: [isnotnull(year" in some._jdf.queryExecution().executedPlan().toString()
