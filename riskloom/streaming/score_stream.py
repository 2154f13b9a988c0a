"""Scoring records as they arrive (stateless): file/JSON stream → the same
scoring transform as batch → an append sink with a checkpoint in the shared
folder, so a restarted query resumes exactly where it stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_record_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                       max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def start_append(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = True, trigger_interval: str | None = None):
    """Append sink with a checkpoint (exactly-once file output)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger_interval or "10 seconds")
    return w.start(out_path)


def start_complete_table(df: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Complete-mode result (e.g. windowed aggregates) rewritten as a table at
    every micro-batch via foreachBatch."""
    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)
    w = (df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(write))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def score_stream(spark: SparkSession, source: str, schema: T.StructType,
                 scorer: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                 available_now: bool = True):
    """Start the scoring stream; returns the StreamingQuery."""
    records = read_record_stream(spark, source, schema)
    return start_append(scorer(records), out_path, checkpoint, available_now=available_now)
