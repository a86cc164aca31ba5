"""Ranking within groups.

``rank_within`` + a ``rank <= n`` filter is planned by Spark as a
``WindowGroupLimit`` (partial before the shuffle, final after it), so the
window sort only sees the candidate rows of each group. Ties share a rank
(SQL RANK), so a group can keep more than ``n`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, partition_by: list[str], order_by: list[Column],
                name: str = "rank") -> DataFrame:
    """Add SQL RANK() over ``partition_by`` ordered by ``order_by`` as ``name``."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(name, F.rank().over(w))


def top_n_per_group(df: DataFrame, partition_by: list[str], order_by: list[Column],
                    n: int, name: str = "rank") -> DataFrame:
    """Rows ranked ``<= n`` within their group (ties kept)."""
    return rank_within(df, partition_by, order_by, name).filter(F.col(name) <= n)
