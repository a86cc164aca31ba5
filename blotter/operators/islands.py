"""Gaps and islands: runs of a key's rows no more than a gap apart.

Rows of one key and time are counted first, and these counts written: what
follows reads them twice, and a filter on a bucket would else be computed
from each row's time before the count. Within a key and time bucket a
row's predecessor is the one before it; the first row's is the last of the
bucket before that has rows, carried in a table of one row per key and
bucket, as is the number of runs begun so far. So a key that holds most of
the rows is worked on bucket by bucket, in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .intervals import _all_known
from .times import seconds


def islands(df: DataFrame, on: list[str], at: str, gap: int, bucket: int = 30 * 86400) -> DataFrame:
    """(on, island, start, end, n): each key's runs in which no row is more than ``gap`` seconds after the last.

    ``island`` counts from 1 per key in time order; ``start`` and ``end``
    are the first and last time of the run, ``n`` its rows. Rows with a null
    key or time belong to no run.
    """
    counted = materialize(df.groupBy(*on, F.col(at).alias("_at")).agg(F.count(F.lit(1)).alias("_n")), "islands-times")
    times = _all_known(counted, ["_at", *on]).withColumn("_s", seconds(counted, "_at")).withColumn("_bucket", F.floor(F.col("_s") / bucket))
    here = Window.partitionBy(*on, "_bucket").orderBy("_at")
    inner = times.withColumn("_last", F.lag("_s").over(here))
    begins = F.col("_s") - F.col("_last") > gap
    # Per bucket: its first and last time, and the runs that begin inside it after its first row.
    buckets = inner.groupBy(*on, "_bucket").agg(F.min("_s").alias("_first"), F.max("_s").alias("_end"), F.sum(F.when(begins, 1).otherwise(0)).alias("_inside"))
    along = Window.partitionBy(*on).orderBy("_bucket")
    opens = F.coalesce(F.col("_first") - F.lag("_end").over(along) > gap, F.lit(True))
    buckets = buckets.withColumn("_opens", opens.cast("int"))
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    # The run that a bucket's first row belongs to.
    buckets = buckets.select(*on, "_bucket", (F.sum(F.col("_opens") + F.col("_inside")).over(upto) - F.col("_inside")).alias("_base"))
    numbered = inner.withColumn("_k", F.sum(F.when(begins, 1).otherwise(0)).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    named = numbered.join(buckets, [*on, "_bucket"]).withColumn("island", F.col("_base") + F.col("_k"))
    return named.groupBy(*on, "island").agg(F.min("_at").alias("start"), F.max("_at").alias("end"), F.sum("_n").alias("n"))
