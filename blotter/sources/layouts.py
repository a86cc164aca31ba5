"""Reading the public source files by their own header names.

The city publishes its incident extracts, the reverse-geocoding table, the
per-ZIP income table and the station list as CSV with human-readable
headers (``DATE OCC``, ``AREA `` with a trailing blank in one release and
without it in another, ``Estimated Median Income`` ...). ``read_extract``
reads such a file (or its all-text Parquet copy), keeps *every* column,
and renames each header to a snake-case name; the headers the questions
use map onto the names of ``sources.schemas``. Keeping all columns matters:
the two incident files are de-duplicated on whole rows, so two rows that
differ only in a column no question reads are still two incidents.

Header matching ignores case and surrounding blanks, so ``AREA `` and
``AREA`` are the same column and the two releases union by name.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import read_with_header, files_by_header

# Source-file headers the questions read, and their column names here.
INCIDENT_HEADERS = {
    "DR_NO": "dr_no",
    "DATE OCC": "date_occ",
    "TIME OCC": "time_occ",
    "AREA": "area",
    "Premis Desc": "premis_desc",
    "Vict Descent": "vict_descent",
    "Weapon Used Cd": "weapon_cd",
    "LAT": "lat",
    "LON": "lon",
}
REVGEO_HEADERS = {"LAT": "lat", "LON": "lon", "ZIPcode": "zip"}
INCOME_HEADERS = {"Zip Code": "zip", "Community": "community", "Estimated Median Income": "median_income"}
STATION_HEADERS = {"PREC": "prec", "DIVISION": "division", "X": "x", "Y": "y"}

LAYOUTS = {
    "incidents": INCIDENT_HEADERS,
    "revgeo": REVGEO_HEADERS,
    "income": INCOME_HEADERS,
    "stations": STATION_HEADERS,
}


def _key(header: str) -> str:
    return header.strip().lower()


def snake(header: str) -> str:
    """``'Vict Age'`` -> ``'vict_age'``; any run of non-alphanumerics -> ``_``."""
    return re.sub(r"[^0-9a-z]+", "_", header.strip().lower()).strip("_")


def column_names(headers: list[str], layout: dict[str, str]) -> list[str]:
    known = {_key(h): name for h, name in layout.items()}
    names = [known.get(_key(h), snake(h)) for h in headers]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"headers collide after normalising: {sorted(dup)}")
    return names


def read_extract(spark: SparkSession, paths: str | list[str], kind: str, fmt: str = "csv") -> DataFrame:
    """A source file of ``kind`` (incidents, revgeo, income, stations), all columns as text."""
    layout = LAYOUTS[kind]
    paths = [paths] if isinstance(paths, str) else list(paths)
    if fmt == "csv":
        frames = [read_with_header(spark, files, header) for header, files in files_by_header(spark, paths).items()]
    elif fmt == "parquet":
        frames = [spark.read.parquet(*paths)]
    else:
        raise ValueError(f"unknown format {fmt!r}")

    def named(df: DataFrame) -> DataFrame:
        names = column_names(df.columns, layout)
        missing = [n for n in layout.values() if n not in names]
        if missing:
            raise ValueError(f"{kind} file lacks columns {missing}")
        return df.select(*[F.col(f"`{h}`").alias(n) for h, n in zip(df.columns, names)])

    # Files of different headers line up by name, after their headers are brought to one form.
    return reduce(lambda a, b: a.unionByName(b), [named(f) for f in frames])
