"""The questions' answers kept up to date as extracts arrive.

Each batch of new rows is reduced to partial counts and sums, which are
added to the totals of the batch before: incidents per year and month (Q1),
street incidents per part of day (Q2), firearm incidents and kilometres per
division (Q4). The totals have a row per month, part of day and division,
whatever the incidents' number, and answer the questions as they are. A
batch that is repeated replaces its own totals, never adds to them twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.daypart import daypart_text
from ..operators.filters import where_equals
from ..operators.window import top_n_per_group
from ..plans import q2, q4
from ..sources.typed import typed_incidents
from .dedup import csv_arrivals, first_arrivals
from .state import BatchTables
from .windows import run_batches

def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TOTALS = {
    "months": _schema(year=T.IntegerType(), month=T.IntegerType(), n=T.LongType()),
    "dayparts": _schema(time_of_day=T.StringType(), n=T.LongType()),
    "divisions": _schema(division=T.StringType(), n=T.LongType(), measured=T.LongType(), km=T.DoubleType()),
}


class Answers:
    """The totals under ``base``, fed batch by batch with raw incidents that are no copies of earlier ones."""

    def __init__(self, spark: SparkSession, base: str, stations: DataFrame):
        self.tables, self.stations = BatchTables(spark, base), stations

    def _partials(self, incidents: DataFrame) -> dict[str, DataFrame]:
        months = incidents.groupBy(F.year("date_occ").alias("year"), F.month("date_occ").alias("month")).agg(F.count(F.lit(1)).alias("n"))
        street = where_equals(incidents, "premis_desc", q2.STREET)
        dayparts = street.groupBy(daypart_text("time_occ").alias("time_of_day")).agg(F.count(F.lit(1)).alias("n"))
        rows = q4.with_distance(q4.incidents_with_station(incidents, self.stations))
        divisions = rows.groupBy("division").agg(F.count(F.lit(1)).alias("n"), F.count("distance").alias("measured"), F.coalesce(F.sum("distance"), F.lit(0.0)).alias("km"))
        return {"months": months, "dayparts": dayparts, "divisions": divisions}

    def add(self, raw: DataFrame, batch: int) -> None:
        """Take in one batch of raw incidents; the function of a stream's ``foreachBatch``."""
        t = self.tables
        # The stateful step above is run once, whatever reads its rows.
        rows = t.write("rows", batch, raw)
        partials = self._partials(typed_incidents(rows))
        for name, schema in TOTALS.items():
            keys = schema.names[:schema.names.index("n")]
            before = t.read(name, t.before(name, batch), schema)
            both = before.unionByName(partials[name].select(*schema.names))
            totals = both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in schema.names[len(keys):]])
            t.write(name, batch, totals.coalesce(1))
            t.drop_before(name, batch - 1)
        t.drop_before("rows", batch)

    def _totals(self, name: str) -> DataFrame:
        done = self.tables.batches(name)
        return self.tables.read(name, done[-1] if done else None, TOTALS[name])

    def top_months(self, n: int = 3) -> DataFrame:
        """Q1: the ``n`` months of each year with most incidents."""
        counts = self._totals("months").withColumnRenamed("n", "count")
        return top_n_per_group(counts, ["year"], [F.col("count").desc()], n)

    def street_by_daypart(self) -> DataFrame:
        """Q2: street incidents per part of day, most first."""
        return self._totals("dayparts").withColumnRenamed("n", "count").orderBy(F.col("count").desc(), "time_of_day")

    def station_distance(self) -> DataFrame:
        """Q4: per division the mean distance from firearm incidents to the station, and their number."""
        mean = F.when(F.col("measured") > 0, F.round(F.col("km") / F.col("measured"), q4.DISTANCE_DECIMALS))
        return (self._totals("divisions").select("division", mean.alias("average_distance"), F.col("n").alias("number_of_incidents"))
                .orderBy(F.col("number_of_incidents").desc(), "division"))


def update_available(spark: SparkSession, path: str, base: str, schema: T.StructType, stations: DataFrame,
                     horizon: str = "400 days", max_files: int | None = None) -> Answers:
    """Bring the answers under ``base`` up to date with every raw CSV extract now at ``path``."""
    answers = Answers(spark, f"{base}/totals", stations)
    run_batches(first_arrivals(csv_arrivals(spark, path, schema, max_files), horizon), answers.add, f"{base}/checkpoint")
    return answers
