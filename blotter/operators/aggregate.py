"""Grouped aggregates.

All of them are hash aggregates with a partial (map-side) step, so a hot
key is reduced to one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    """One row per key with the number of rows (``count`` by default)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by_key(df: DataFrame, key: str | Column, value: str | Column,
               name: str = "total") -> DataFrame:
    """The DataFrame form of ``reduceByKey(+)``: one sum per key."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(key).agg(F.sum(v).alias(name))


def one_per_key(df: DataFrame, key: str, order_by: list[str] | None = None) -> DataFrame:
    """One deterministic row per key: the row with the largest ``order_by``
    values (all non-key columns by default).

    This is what a dict built from key/value pairs gives in one process
    ("last wins"), made deterministic for a distributed frame. It is an
    ordinary aggregate (``max_by`` of a struct), so it is partial-aggregated
    before the shuffle and never collects a group.
    """
    rest = [c for c in df.columns if c != key]
    order = order_by or rest
    row = F.struct(*[F.col(c) for c in rest])
    ordering = F.struct(*[F.col(c) for c in order])
    return (df.groupBy(key)
              .agg(F.max_by(row, ordering).alias("_row"))
              .select(key, *[F.col("_row")[c].alias(c) for c in rest]))
