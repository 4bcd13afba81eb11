"""Windowed counts of a stream of files.

Every file there is read, in micro-batches, and the query stops. The newest window is emitted
too: results are those of complete mode, which keeps a row for each window and key.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.scratch import scratch, shared_path


def file_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of the Parquet files in a folder, or of one file."""
    schema = spark.read.parquet(path).schema
    folder, name = os.path.split(path.rstrip("/"))
    single = spark.read.parquet(path).inputFiles()[:1] == [path] or not _is_folder(spark, path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return source.option("pathGlobFilter", name).parquet(folder) if single else source.parquet(path)


def _is_folder(spark: SparkSession, path: str) -> bool:
    from ..sinks.scratch import file_system

    _, at, fs = file_system(spark, path)
    return fs.getFileStatus(at).isDirectory()


def run_to_end(stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over all that is there; return what it emitted last (complete), or all that it emitted.

    Executors write each batch to the shared storage; nothing gathers on the driver.
    """
    spark = stream.sparkSession
    out, batches = shared_path(spark, "stream"), []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch-{number:08d}")  # a batch that runs again replaces itself
        batches.append(f"{out}/batch-{number:08d}")

    with scratch(spark) as checkpoint:
        q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
    if not batches:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*(batches[-1:] if mode == "complete" else batches))


def window_counts(spark: SparkSession, path: str, interval: str = "1 hour") -> DataFrame:
    events = file_stream(spark, path).withColumn("at", F.col("ts").cast("timestamp"))
    counted = events.groupBy(F.window("at", interval).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return run_to_end(counted, "complete").select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")
