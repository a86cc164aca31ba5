"""Global top-k / bottom-k.

``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: each
task keeps its own k best rows and only those reach the final merge, so
no global sort and no shuffle of the data. Ties are broken by the
``tiebreak`` columns so the answer is deterministic; null measures never
win (they are dropped).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, k: int, tiebreak: list[str] | None = None) -> DataFrame:
    """The ``k`` rows with the largest ``measure`` (nulls never win; ties by ``tiebreak``)."""
    order = [F.col(measure).desc()] + [F.col(c).asc() for c in tiebreak or []]
    return df.filter(F.col(measure).isNotNull()).orderBy(*order).limit(k)


def bottom_k(df: DataFrame, measure: str, k: int, tiebreak: list[str] | None = None) -> DataFrame:
    """The ``k`` rows with the smallest ``measure`` (nulls never win; ties by ``tiebreak``)."""
    order = [F.col(measure).asc_nulls_last()] + [F.col(c).asc() for c in tiebreak or []]
    return df.filter(F.col(measure).isNotNull()).orderBy(*order).limit(k)
