"""The typed step: one projection of tolerant casts over a raw extract.

Each spec maps a column to a Column -> Column converter; columns without
an entry pass through as text. Converting in a single ``select`` keeps
the plan to one Project, and casts of columns a query never reads are
pruned by the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import parse_money, parse_timestamp, to_double, to_int, to_long

Converter = Callable[[Column], Column]

INCIDENTS: Mapping[str, Converter] = {
    "dr_no": to_long,
    "date_rptd": parse_timestamp,   # present in the published files only
    "vict_age": to_int,             # idem
    "date_occ": parse_timestamp,
    "area": to_int,
    "weapon_cd": to_int,
    "lat": to_double,
    "lon": to_double,
}
STATIONS: Mapping[str, Converter] = {"prec": to_int, "x": to_double, "y": to_double}
INCOME: Mapping[str, Converter] = {"zip": to_int, "median_income": parse_money}
REVGEO: Mapping[str, Converter] = {"lat": to_double, "lon": to_double, "zip": to_int}
HOUSEHOLDS: Mapping[str, Converter] = {
    "household_id": to_long, "zip": to_int, "median_income": parse_money,
}


def typed(df: DataFrame, spec: Mapping[str, Converter]) -> DataFrame:
    """One projection applying ``spec`` to the raw text columns."""
    return df.select(*_projection(spec, tuple(df.columns)))


def _projection(spec: Mapping[str, Converter], columns: tuple[str, ...]) -> list[Column]:
    return [(spec[c](F.col(c)) if c in spec else F.col(c)).alias(c) for c in columns]


SPECS: dict[str, Mapping[str, Converter]] = {
    "incidents": INCIDENTS, "stations": STATIONS, "income": INCOME,
    "revgeo": REVGEO, "households": HOUSEHOLDS,
}


@cache
def _named_projection(name: str, columns: tuple[str, ...]) -> tuple[Column, ...]:
    # Built once per (table, layout) and reused: Columns are immutable.
    return tuple(_projection(SPECS[name], columns))


def _typed_named(df: DataFrame, name: str) -> DataFrame:
    return df.select(*_named_projection(name, tuple(df.columns)))


def typed_incidents(df: DataFrame) -> DataFrame:
    return _typed_named(df, "incidents")


def typed_stations(df: DataFrame) -> DataFrame:
    return _typed_named(df, "stations")


def typed_income(df: DataFrame) -> DataFrame:
    return _typed_named(df, "income")


def typed_revgeo(df: DataFrame) -> DataFrame:
    return _typed_named(df, "revgeo")


def typed_households(df: DataFrame) -> DataFrame:
    return _typed_named(df, "households")
