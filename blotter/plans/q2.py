"""Q2: street incidents by part of the day, busiest first.

Filter on the premise, bucket the ``HHmm`` text, count per bucket. The
premise filter is pushed below the de-duplication of the extracts, so
only street rows are shuffled; the count is a partial + final aggregate
over at most five keys, and the final sort touches five rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.daypart import daypart_number, daypart_text
from ..operators.aggregate import group_count
from ..operators.filters import where_equals

# Fixed value: the premise the question is about.
STREET = "STREET"


def street_by_daypart(incidents: DataFrame,
                      bucket: Callable[[Column | str], Column] = daypart_text) -> DataFrame:
    """Street incidents counted per part of the day, busiest first."""
    street = where_equals(incidents, "premis_desc", STREET)
    parts = street.select(bucket("time_occ").alias("time_of_day"))
    return group_count(parts, "time_of_day", name="count").orderBy(F.col("count").desc(), "time_of_day")


def street_by_daypart_text(incidents: DataFrame) -> DataFrame:
    """Q2 with the lexical (text) buckets."""
    return street_by_daypart(incidents, daypart_text)


def street_by_daypart_number(incidents: DataFrame) -> DataFrame:
    """Q2 with the integer buckets."""
    return street_by_daypart(incidents, daypart_number)
