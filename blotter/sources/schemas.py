"""Declared schemas of the raw extracts and of their typed forms.

Raw extracts arrive as text (CSV with a header row), so every raw column
is a string; reading with a declared schema avoids an inference pass over
the data; files are bound to it by the names in their header rows. The typed
step (``sources.typed``) then imposes real types with tolerant casts.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


INCIDENTS_RAW = _strings(
    "dr_no", "date_occ", "time_occ", "area", "premis_desc",
    "vict_descent", "weapon_cd", "lat", "lon",
)
STATIONS_RAW = _strings("prec", "division", "x", "y")
INCOME_RAW = _strings("zip", "community", "median_income")
REVGEO_RAW = _strings("lat", "lon", "zip")
HOUSEHOLDS_RAW = _strings("household_id", "zip", "community", "median_income")

RAW_SCHEMAS = {
    "incidents": INCIDENTS_RAW,
    "stations": STATIONS_RAW,
    "income": INCOME_RAW,
    "revgeo": REVGEO_RAW,
    "households": HOUSEHOLDS_RAW,
}

INCIDENTS_TYPED = T.StructType([
    T.StructField("dr_no", T.LongType()),
    T.StructField("date_occ", T.TimestampNTZType()),
    T.StructField("time_occ", T.StringType()),
    T.StructField("area", T.IntegerType()),
    T.StructField("premis_desc", T.StringType()),
    T.StructField("vict_descent", T.StringType()),
    T.StructField("weapon_cd", T.IntegerType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])
