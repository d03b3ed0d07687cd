"""Arrival-time scoring as a Structured Streaming job.

The reference serves its scoring rule one request at a time.  Here requests
arrive as files (Parquet) in a folder; each micro-batch is scored with the
native rule expression and appended to a Parquet sink.  The checkpoint
location (in the shared checkpoint folder) records which files were done, so
a restarted query neither loses nor repeats rows (the file sink is
exactly-once).  No state is kept between batches: the rule is row-local.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.scoring import predicted_arrival_hhmm


def scored_stream(spark: SparkSession, source_dir: str, schema, max_files_per_trigger: int | None = None
                  ) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    return stream.withColumn("pred_arr_time", predicted_arrival_hhmm("sched_arr_time", "dep_delay"))


def start_scoring(spark: SparkSession, source_dir: str, schema, sink_dir: str, checkpoint_dir: str,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the scorer.  ``available_now`` processes what is there and stops
    (batch-like runs); otherwise it polls every ``processing_time``."""
    writer = (scored_stream(spark, source_dir, schema).writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "10 seconds")
    return writer.start()
