"""Incremental ingest: new crash files -> clean rows, with Structured Streaming.

Every cleaning step is row-wise (no aggregation, no state), so the batch
pipeline runs unchanged on a streaming frame: each micro-batch reads only
the files that arrived since the last one, and the file sink plus the
stream checkpoint give exactly-once output across restarts and lost
executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadframe.plans.cleaning import clean_crashes
from roadframe.schema import raw_schema



def crash_stream(spark: SparkSession, source_dir: str, schema: T.StructType | None = None,
                 max_files_per_trigger: int | None = None, sep: str = ",") -> DataFrame:
    """Streaming frame of the raw crash files in ``source_dir`` (header row
    checked against the explicit all-string schema)."""
    reader = (spark.readStream.schema(schema or raw_schema())
              .option("header", "true").option("enforceSchema", "false").option("sep", sep))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.csv(source_dir)


def clean_stream(spark: SparkSession, source_dir: str, **kwargs) -> DataFrame:
    """The cleaning pipeline over the crash file stream."""
    return clean_crashes(crash_stream(spark, source_dir, **kwargs))


def start_clean_ingest(spark: SparkSession, source_dir: str, sink_dir: str,
                       checkpoint_location: str | None = None, available_now: bool = True,
                       processing_time: str | None = None, max_files_per_trigger: int | None = None,
                       sep: str = ",", schema: T.StructType | None = None) -> StreamingQuery:
    """Start the ingest into Parquet files under ``sink_dir``. With
    ``available_now`` it processes every file present and stops; otherwise
    it polls every ``processing_time``.

    The stream's checkpoint (which files are done) defaults to the hidden
    folder ``_ingest_checkpoint`` inside the sink, so it is the same for
    every application that writes this sink: starting the ingest again
    resumes where it stopped and picks up only new files. (Spark readers
    skip ``_`` folders; the sink's own log lists the committed files.)
    ``max_files_per_trigger`` bounds each micro-batch of a large backlog."""
    location = checkpoint_location or f"{sink_dir.rstrip('/')}/_ingest_checkpoint"
    stream = clean_stream(spark, source_dir, schema=schema,
                          max_files_per_trigger=max_files_per_trigger, sep=sep)
    writer = (stream.writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", location)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
