"""Tables laid out for the joins and filters to come: bucketed by key, or partitioned.

Two tables bucketed by the same key into the same number of buckets are
joined, and grouped by the key, where they lie: no exchange, however often
it is asked. A partitioned table reads only the partitions a filter leaves,
also those that a join with a filtered dimension leaves (dynamic pruning).

Tables are named in the session's catalog; their files are in the shared
folder (``session.shared_dir``), or where ``path`` says. Buckets of a hot key are as uneven as
the key is: bucket by a key that spreads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def write_bucketed(df: DataFrame, prefix: str, keys: list[str], buckets: int, path: str | None = None) -> str:
    """Write ``df`` as a new table bucketed and sorted by ``keys``; its name.

    Rows are dealt out by the bucket function first, so a bucket is one file
    instead of one per task.
    """
    if buckets < 1:
        raise ValueError("a table has at least one bucket")
    name = _name(prefix)
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path or shared_dir(df.sparkSession, name)).saveAsTable(name)
    return name


def write_partitioned(df: DataFrame, prefix: str, by: list[str], path: str | None = None) -> str:
    """Write ``df`` as a new table partitioned by ``by``, each partition by all tasks that have rows of it; its name."""
    name = _name(prefix)
    df.write.partitionBy(*by).option("path", path or shared_dir(df.sparkSession, name)).saveAsTable(name)
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
