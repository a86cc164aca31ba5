"""Raw domain extracts derived from the driver's tables.

The questions are about incidents, police stations, per-ZIP income and a
reverse-geocoding table. The test data is a TPC-H-like star schema, so
each domain extract is a projection of a driver table written as the raw
text a CSV export would hold (all columns strings). The derivation rules
are listed in FIXTURES.md section 3; ``plans/oracle.py`` restates them in
SQL for the DuckDB oracle. Coordinates are written as exact decimal text
(thousandths of a degree) so both engines parse the same doubles.

Every extract is a lazy scan of one Parquet table with only the needed
columns, so it grows with the data and keeps column pruning and filter
pushdown.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.descent import DESCENT_LABELS
from . import schemas
from .typed import (typed_households, typed_incidents, typed_income, typed_revgeo,
                    typed_stations)

# Fixed values of the fixture rules (FIXTURES.md section 3).
DESCENT_LETTERS = "".join(DESCENT_LABELS)      # every code of the label table, in order
SPLIT_A_BEFORE = "1999-01-01"     # extract A: date_occ before this day
SPLIT_B_FROM = "1998-07-01"       # extract B: date_occ from this day on
UNKNOWN_COORD_TEXT = "0"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A driver table with only ``cols`` read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*cols)


def milli_text(v: Column) -> Column:
    """Non-negative integer thousandths -> ``'d.ddd'`` text."""
    return F.concat((v / 1000).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((v % 1000).cast("string"), 3, "0"))


def lat_text(i: Column) -> Column:
    return milli_text(F.lit(33000) + i * 37 % 2000)


def lon_text(i: Column) -> Column:
    return F.concat(F.lit("-"), milli_text(F.lit(117000) + F.floor(i / 2000) * 7 % 60000))


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def wall_clock_text(ts: Column) -> Column:
    """``timestamp_ntz`` -> ``'MM/dd/yyyy hh:mm:ss AM'`` from its own fields.

    Built from the wall-clock fields rather than ``date_format``, which goes
    through the session time zone and would shift times that fall in a
    daylight-saving gap of that zone.
    """
    hour = F.hour(ts)
    return F.concat(_two(F.month(ts)), F.lit("/"), _two(F.dayofmonth(ts)), F.lit("/"),
                    F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit(" "),
                    _two((hour + 11) % 12 + 1), F.lit(":"), _two(F.minute(ts)), F.lit(":"),
                    _two(F.second(ts)), F.lit(" "),
                    F.when(hour < 12, F.lit("AM")).otherwise(F.lit("PM")))


def _ntz(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


# Expression trees are built once per process and reused: a Column is an
# immutable, unresolved expression, and building one costs JVM round trips.
@cache
def _extract_filter(extract: str) -> Column:
    if extract == "a":
        return F.col("o_orderdate") < _ntz(SPLIT_A_BEFORE)
    if extract == "b":
        return F.col("o_orderdate") >= _ntz(SPLIT_B_FROM)
    raise ValueError(f"unknown extract {extract!r}")


@cache
def _incident_text() -> tuple[Column, ...]:
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    unknown = k % 97 == 0
    letters = F.array(*[F.lit(ch) for ch in DESCENT_LETTERS])
    return (
        k.cast("string").alias("dr_no"),
        F.when(k % 101 == 0, F.lit("bad")).otherwise(wall_clock_text(F.col("o_orderdate"))).alias("date_occ"),
        F.lpad((k * 7 % 2500).cast("string"), 4, "0").alias("time_occ"),
        (cust % 27 + 1).cast("string").alias("area"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("STREET"))
         .otherwise(F.col("o_orderpriority")).alias("premis_desc"),
        F.try_element_at(letters, (cust % 20 + 1).cast("int")).alias("vict_descent"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .otherwise((k % 300).cast("string")).alias("weapon_cd"),
        F.when(unknown, F.lit(UNKNOWN_COORD_TEXT)).otherwise(lat_text(cust)).alias("lat"),
        F.when(unknown, F.lit(UNKNOWN_COORD_TEXT)).otherwise(lon_text(cust)).alias("lon"),
    )


def incidents_raw(spark: SparkSession, sf_dir: str, extract: str | None = None) -> DataFrame:
    """One text row per ``orders`` row; ``extract`` 'a' / 'b' picks an overlapping file."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if extract is not None:
        o = o.filter(_extract_filter(extract))
    return o.select(*_incident_text())


@cache
def _station_text() -> tuple[Column, ...]:
    n = F.col("n_nationkey")
    return ((n + 1).cast("string").alias("prec"),
            F.col("n_name").alias("division"),
            F.concat(F.lit("-"), milli_text(F.lit(118700) - n * 31 % 600)).alias("x"),
            milli_text(F.lit(33700) + n * 29 % 600).alias("y"))


def stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per nation; two more areas have none."""
    return table(spark, sf_dir, "nation", "n_nationkey", "n_name").select(*_station_text())


def _community(flag: Column, name: Column) -> Column:
    return F.when(flag, F.concat(F.lit("Los Angeles ("), name, F.lit(")"))).otherwise(name)


@cache
def _income_text() -> tuple[Column, ...]:
    n = F.col("n_nationkey")
    return ((F.lit(90000) + n).cast("string").alias("zip"),
            _community(n % 3 != 0, F.col("n_name")).alias("community"),
            F.concat(F.lit("$"), F.format_number(F.lit(30000) + n * 3721, 0)).alias("median_income"))


def income_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation", "n_nationkey", "n_name").select(*_income_text())


@cache
def _revgeo_text() -> tuple[Column, ...]:
    i = F.col("c_custkey")
    return (i % 13 != 0,
            lat_text(i).alias("lat"), lon_text(i).alias("lon"),
            (F.lit(90000) + i % 25).cast("string").alias("zip"))


def revgeo_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ZIP of most customers' positions (one row per position)."""
    keep, *cols = _revgeo_text()
    return table(spark, sf_dir, "customer", "c_custkey").filter(keep).select(*cols)


@cache
def _household_text() -> tuple[Column, ...]:
    c = F.col("c_custkey")
    return (c.cast("string").alias("household_id"),
            (F.lit(90000) + F.col("c_nationkey")).cast("string").alias("zip"),
            _community(c % 3 != 0, F.col("c_mktsegment")).alias("community"),
            F.when(c % 89 == 0, F.lit("n/a"))
             .otherwise(F.concat(F.lit("$"), F.format_number(F.floor("c_acctbal"), 0)))
             .alias("median_income"))


def households_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-household income records (one per ``customer`` row)."""
    return (table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
            .select(*_household_text()))


RAW = {
    "incidents": incidents_raw,
    "stations": stations_raw,
    "income": income_raw,
    "revgeo": revgeo_raw,
    "households": households_raw,
}


def incidents(spark: SparkSession, sf_dir: str, extract: str | None = None) -> DataFrame:
    return typed_incidents(incidents_raw(spark, sf_dir, extract))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_stations(stations_raw(spark, sf_dir))


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_income(income_raw(spark, sf_dir))


def revgeo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_revgeo(revgeo_raw(spark, sf_dir))


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_households(households_raw(spark, sf_dir))


assert set(RAW) == set(schemas.RAW_SCHEMAS)
