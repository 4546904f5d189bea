"""Incremental BTS loading with Structured Streaming (S-05 + K-03 + W-02).

The source loads a large monthly BTS file in 200,000-row chunks, each chunk a
transaction of "normalise -> insert where the airport is known -> skip
snapshot ids already present". As a stream: new CSV files dropped into a
folder are micro-batches, each file read by its own header; each micro-batch
runs the same normalisation and an insert-ignore against the target table
inside ``foreachBatch``.

The stream itself carries the names of the new files only (their content is not
read for that). A batch is one committed write, named after the query and the
batch, so a batch that dies leaves nothing and one that is replayed changes
nothing; progress is tracked in a checkpoint under the session's shared
``spark.checkpoint.dir``. ``trigger(availableNow=True)`` processes what is
there and stops, which is how a scheduled batch loader runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from airdata.session import checkpoint_dir
from airdata.sources import sinks
from airdata.sources.files import load_monthly

FP_SCHEMA = T.StructType([
    T.StructField("snapshot_id", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()), T.StructField("airline_iata", T.StringType()),
    T.StructField("airport_iata", T.StringType()), T.StructField("arrivals", T.IntegerType()),
    T.StructField("arrivals_delayed_15min", T.IntegerType()),
    T.StructField("arr_cancelled", T.IntegerType()), T.StructField("arr_diverted", T.IntegerType()),
    *[T.StructField(c, T.DoubleType()) for c in (
        "total_arrival_delay_min", "carrier_delay", "weather_delay", "nas_delay",
        "security_delay", "late_aircraft_delay")],
])


def stream_bts_folder(spark: SparkSession, inbox: str, target: str, airports: DataFrame, rejects: str | None = None,
                      query_name: str = "bts_incremental", checkpoint: str | None = None,
                      airlines: DataFrame | None = None, files_per_batch: int = 1000):
    """Start (and run to completion) the incremental load of every CSV in
    ``inbox``, of any known layout, into the table at ``target`` (see
    ``sources.sinks``), and of what cannot be loaded into that at ``rejects``."""
    names = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_per_batch)
                  .load(inbox).select("path"))
    ckpt = checkpoint or sinks.join(checkpoint_dir(spark), "streams", query_name)

    def load(batch: DataFrame, batch_id: int) -> None:
        session, files = batch.sparkSession, [r["path"] for r in batch.collect()]   # files_per_batch names
        if not files:
            return
        # the target is partitioned by (year, month), which are parts of the key
        existing = sinks.read_table(session, target, FP_SCHEMA)
        done = load_monthly(session, files, existing, airports, airlines)
        key = f"{query_name}-{batch_id}"
        if rejects:
            sinks.append_table(done.rejects, rejects, key)
        sinks.append_table(done.insert.select(*FP_SCHEMA.names), target, key, ["year", "month"])

    q = (names.writeStream.foreachBatch(load).option("checkpointLocation", ckpt)
              .queryName(query_name).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
