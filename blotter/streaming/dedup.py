"""Rows of re-exported extracts once: stateful de-duplication of a stream.

Extracts overlap, and a period that was exported before arrives again. The
stream keeps a digest of every row it has passed on, in Spark's state store,
and drops rows whose digest it holds. A digest is kept for ``horizon`` after
its row arrived (arrival is the file's modification time), which is what
bounds the state: a copy that arrives later than that is taken for a new
row. The rows' own dates don't matter for that, so rows with a broken date
are de-duplicated like others. Restarted with the same checkpoint, the
stream goes on with the state it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRIVED, DIGEST = "_arrived", "_digest"


def row_digest(columns: list[str]) -> Column:
    """32 bytes that are equal for equal rows only: every value with its length, null apart from any text."""
    def part(c: str) -> Column:
        v = F.col(f"`{c}`").cast("string")
        return F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-"))

    return F.unhex(F.sha2(F.concat_ws("|", *[part(c) for c in columns]), 256))


def csv_arrivals(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """CSV files as they arrive, with the time each was written; a header other than ``schema``'s is an error."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.csv(path).select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))


def first_arrivals(arrivals: DataFrame, horizon: str = "400 days") -> DataFrame:
    """The rows of a stream of ``arrivals`` without copies of rows that arrived within ``horizon`` before."""
    columns = [c for c in arrivals.columns if c != ARRIVED]
    marked = arrivals.withColumn(DIGEST, row_digest(columns)).withWatermark(ARRIVED, horizon)
    return marked.dropDuplicatesWithinWatermark([DIGEST]).select(*columns)


def deduplicate_available(spark: SparkSession, path: str, out_dir: str, schema: T.StructType, checkpoint: str,
                          horizon: str = "400 days", max_files: int | None = None) -> DataFrame:
    """Append the rows of every file now at ``path`` that are not copies to ``out_dir``; the table read back."""
    rows = first_arrivals(csv_arrivals(spark, path, schema, max_files), horizon)
    q = (rows.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.schema(schema).parquet(out_dir)
