"""File-arrival ingest with exactly-once file tracking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, max_files: int | None = None, pattern: str | None = None) -> DataFrame:
    """Stream of newly arrived Parquet files with each row's file."""
    reader = spark.readStream.schema(schema).option("ignoreCorruptFiles", "false").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(directory).select("*", F.col("_metadata.file_path").alias("_source_file"))


def land_available(stream: DataFrame, target: str, checkpoint: str, partition_by: str | None = None) -> StreamingQuery:
    """Load every file that is not in the checkpoint yet, then stop.

    The checkpoint is the load ledger and the file sink commits whole batches, so a rerun
    or a restart after a failure adds each file once.
    """
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    query = writer.trigger(availableNow=True).start(target)
    query.awaitTermination()
    return query


def apply_available(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Run ``apply`` once per micro-batch of new files; it must be safe to repeat."""
    query = (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
