"""Session helpers.

The library never creates a global session inside an operator; callers pass
DataFrames in. These helpers only build a session for tests, the bench and the
driver entry, and resolve the shared checkpoint directory.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so TIMESTAMP (no zone) behaves like the
# source database, AQE for runtime re-planning (coalescing, skew joins,
# broadcast conversion from measured sizes).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of id assignment / fixpoint rounds are removed once
    # the DataFrames that use them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "airdata", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, named by ``spark.checkpoint.dir``.

    Where the setting is absent, a session whose driver and executors are one
    process (``local[...]``, as in tests) gets a temporary folder; on a cluster
    no folder of one machine would do, so that is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="airdata-checkpoint-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
