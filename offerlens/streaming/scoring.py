"""Micro-batch scoring of arriving offer lines (Structured Streaming).

The reference has no streaming; this runs the existing batch operator --
the discount recommendation -- on each micro-batch of new files, with an
exactly-once file sink (checkpointed progress in the shared folder).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def start_file_scoring(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str,
                       checkpoint_location: str, transform: Callable[[DataFrame], DataFrame],
                       available_now: bool = True, max_files_per_trigger: int | None = None):
    """Read new Parquet files from ``source_dir`` as a stream, apply the
    batch ``transform`` (a DataFrame -> DataFrame operator, stateless per
    row), append to Parquet at ``sink_dir``.  Returns the StreamingQuery."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    out = transform(stream)
    w = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint_location).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
