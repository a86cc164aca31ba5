"""Incremental CSV -> Parquet conversion with Structured Streaming.

The batch conversion (``sources.files.csv_to_parquet``) rewrites every
file on each run. When extracts keep arriving in a landing folder, the
same conversion runs as a file-stream: each trigger picks up only files
it has not seen, the Parquet sink commits them exactly once through its
metadata log, and the checkpoint (beside the output unless named) lets a
restarted job resume where it stopped. ``trigger(availableNow=True)`` processes
everything present, in bounded batches, and stops: the streaming plan
used as a restartable batch job.

The conversion is stateless (no aggregation, no de-duplication), so the
stream keeps no state that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def default_checkpoint(out_dir: str) -> str:
    """Beside the output, the same on every run, so that the next run resumes."""
    return f"{out_dir.rstrip('/')}_checkpoint"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def start_conversion(spark: SparkSession, source: str, out_dir: str, schema: T.StructType,
                     checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                     available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start a CSV-folder -> Parquet-folder stream; returns the running query.

    A file whose header row differs from ``schema`` (names or order) stops
    the stream with an error instead of being bound by position. Without a
    ``checkpoint`` it is ``default_checkpoint(out_dir)``. An output that a
    stream has already written to needs that stream's checkpoint: with a new
    one the sink would skip batches it takes for committed, so that is an
    error.
    """
    checkpoint = checkpoint or default_checkpoint(out_dir)
    if _exists(spark, f"{out_dir.rstrip('/')}/_spark_metadata") and not _exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{out_dir} was written by a stream with another checkpoint than {checkpoint}")
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    writer = (reader.csv(source).writeStream.format("parquet")
              .option("path", out_dir)
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def convert_available(spark: SparkSession, source: str, out_dir: str, schema: T.StructType,
                      checkpoint: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Convert every file now in ``source``, wait, and return the Parquet table."""
    q = start_conversion(spark, source, out_dir, schema, checkpoint, max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(out_dir)
