"""Counts per event-time window, with a watermark, and a side table of what came too late.

Each batch adds its counts to the windows still open, moves the watermark to
the latest time seen less ``delay``, and closes the windows that end by it:
closed windows are written once and never change. A row whose window had
closed before its batch goes to the side table, whole, as does a row without
a time, so no row is lost: closed and open windows and the side table
together count every row.

What a batch keeps for the next is one row per key and open window, and the
watermark. Everything is written per batch (``state.BatchTables``), so a
batch that is repeated after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.times import seconds
from .state import BatchTables

MARK = T.StructType([T.StructField("watermark", T.LongType())])


class WindowCounts:
    """Counts of rows per ``keys`` and window of ``width`` seconds, fed batch by batch."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, at: str, keys: list[str], width: int, delay: int):
        if width <= 0 or delay < 0:
            raise ValueError("width must be positive and delay not negative")
        if {"window_start", "n", "why"} & set(schema.names):
            raise ValueError("the rows have a column window_start, n or why")
        self.tables = BatchTables(spark, base)
        self.rows, self.at, self.keys, self.width, self.delay = schema, at, list(keys), width, delay
        self.counts = T.StructType([*(schema[k] for k in keys), T.StructField("window_start", T.LongType()), T.StructField("n", T.LongType())])
        self.aside_schema = T.StructType([*schema.fields, T.StructField("why", T.StringType())])

    def _watermark(self, batch: int | None) -> int | None:
        return self.tables.read("marks", batch, MARK).first()["watermark"] if batch is not None else None

    def add(self, batch_rows: DataFrame, batch: int) -> None:
        """Take in one batch; the function of a stream's ``foreachBatch``."""
        t = self.tables
        last = t.before("marks", batch)
        mark = self._watermark(last)
        start = F.floor(seconds(batch_rows, self.at) / self.width) * self.width
        rows = batch_rows.withColumn("window_start", start.cast("bigint"))
        closed_before = F.col("window_start") + self.width <= mark if mark is not None else F.lit(False)
        why = F.when(F.col(f"`{self.at}`").isNull(), F.lit("no time")).when(closed_before, F.lit("late"))
        rows = rows.withColumn("why", why)
        t.write("aside", batch, rows.filter("why IS NOT NULL").select(*self.aside_schema.names))
        timed = rows.filter("why IS NULL").withColumn("_s", seconds(batch_rows, self.at))
        fresh = t.write("fresh", batch, timed.groupBy(*self.keys, "window_start").agg(F.count(F.lit(1)).alias("n"), F.max("_s").alias("latest")))
        # Late rows are earlier than the watermark, so they can't move it.
        latest = fresh.agg(F.max("latest")).first()[0]
        now = max((x for x in (mark, None if latest is None else latest - self.delay) if x is not None), default=None)
        held = t.read("open", last, self.counts).unionByName(fresh.select(*self.counts.names))
        merged = held.groupBy(*self.keys, "window_start").agg(F.sum("n").alias("n")).select(*self.counts.names)
        ends = F.col("window_start") + self.width <= now if now is not None else F.lit(False)
        t.write("closed", batch, merged.filter(ends))
        t.write("open", batch, merged.filter(~ends))
        t.write("marks", batch, t.spark.createDataFrame([(now,)], MARK).coalesce(1))
        if last is not None:
            # The batch before the last may still be repeated from what is kept; those before it can't.
            t.drop_before("open", last)
            t.drop_before("fresh", last)

    def closed(self) -> DataFrame:
        """(keys, window_start, n) of the windows that are final; ``window_start`` in seconds."""
        return self.tables.read_all("closed", self.counts)

    def open(self) -> DataFrame:
        """The windows that may still grow."""
        done = self.tables.batches("marks")
        return self.tables.read("open", done[-1] if done else None, self.counts)

    def aside(self) -> DataFrame:
        """The rows in no window, and why: ``late`` or ``no time``."""
        return self.tables.read_all("aside", self.aside_schema)


def run_batches(source: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Feed what is now in a streaming ``source`` to ``each`` (rows, batch number), then stop."""
    q = source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Parquet files as they arrive, at most ``max_files`` of them a batch."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader.parquet(path)


def count_available(spark: SparkSession, path: str, base: str, schema: T.StructType, at: str, keys: list[str], width: int, delay: int,
                    max_files: int | None = None) -> WindowCounts:
    """Take in every file now at ``path`` that was not taken in before; the counts and tables under ``base``."""
    counts = WindowCounts(spark, f"{base}/tables", schema, at, keys, width, delay)
    run_batches(parquet_stream(spark, path, schema, max_files), counts.add, f"{base}/checkpoint")
    return counts
