"""S-01 scan_table: read the driver's parquet tables.

Plain ``spark.read.parquet``: Catalyst prunes columns and pushes filters into
the scan, so callers select only what they use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from airdata.session import checkpoint_dir

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def scan_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as parquet beside the checkpoints, and a scan of it.

    Readers take only the columns they need and see the same rows; a checkpoint
    would compute its last stage twice and hand every reader whole rows."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
