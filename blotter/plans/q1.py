"""Q1: the three busiest months of each year.

Year and month of the occurrence date, one count per (year, month),
ranked within the year by count (ties share a rank, so a year can keep
more than three months). Incidents whose date text does not parse fall
into a null year and are ranked among themselves.

Plan: partial + final hash aggregate on (year, month), then a
``WindowGroupLimit`` keeps only rank <= n candidates per year before the
window itself; the window shuffles by year, but only the aggregated rows
(at most 12 per year) travel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import group_count
from ..operators.window import top_n_per_group

TOP_MONTHS = 3


def top_months(incidents: DataFrame, n: int = TOP_MONTHS, date_col: str = "date_occ") -> DataFrame:
    """Busiest ``n`` months of each year by incident count, with their rank."""
    ym = incidents.select(F.year(date_col).alias("year"), F.month(date_col).alias("month"))
    counted = group_count(ym, "year", "month", name="count")
    return top_n_per_group(counted, ["year"], [F.col("count").desc()], n, name="rank")


TOP_MONTHS_SQL = """
WITH year_month AS (
  SELECT year(date_occ) AS year, month(date_occ) AS month
  FROM {incidents}
), ranked AS (
  SELECT year, month, count(*) AS total_crimes,
         rank() OVER (PARTITION BY year ORDER BY count(*) DESC) AS rank
  FROM year_month
  GROUP BY year, month
)
SELECT year, month, total_crimes, rank
FROM ranked
WHERE rank <= {n}
"""


def top_months_sql(spark: SparkSession, incidents: DataFrame, n: int = TOP_MONTHS) -> DataFrame:
    """The same question as SQL text over the frame (no global temp view)."""
    return spark.sql(TOP_MONTHS_SQL, incidents=incidents, n=int(n))
