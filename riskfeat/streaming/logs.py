"""A log arriving as files, parsed with the batch time-part expressions (stateless)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.timeparts import with_time_parts


def stream_log(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of a log folder with ``days_diff, hour, minute, ..., band`` added."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_time_parts(reader.load(path))


def append_to_table(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = "days_diff",
                    once: bool = True) -> StreamingQuery:
    """Append each micro-batch to a Parquet table (exactly-once through the checkpoint)."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start()
