"""Row filters. All are plain predicates, so Catalyst pushes them through
projections, de-duplication and unions towards the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def where_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` equals ``value`` (null never matches)."""
    return df.filter(_c(column) == F.lit(value))


def where_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where every one of ``columns`` is set."""
    cond = None
    for c in columns:
        cond = _c(c).isNotNull() if cond is None else cond & _c(c).isNotNull()
    return df if cond is None else df.filter(cond)


def where_like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """SQL LIKE: ``%`` and ``_`` are wildcards, everything else (``(`` too) literal."""
    return df.filter(_c(column).like(pattern))


def in_half_open(c: Column | str, lo, hi) -> Column:
    """``lo <= c < hi``; null -> not kept."""
    return (_c(c) >= lo) & (_c(c) < hi)


def nonzero(*columns: str) -> Column:
    """``c != 0`` for every column; null counts as not kept."""
    cond = None
    for c in columns:
        cond = (_c(c) != 0) if cond is None else cond & (_c(c) != 0)
    return cond


# Firearm weapon codes are the half-open range [100, 200).
FIREARM_CODES = (100, 200)


def firearm_with_coordinates(df: DataFrame, weapon: str = "weapon_cd",
                             lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Incidents with a firearm code and a known (non-zero) position."""
    return df.filter(in_half_open(weapon, *FIREARM_CODES) & nonzero(lat, lon))
