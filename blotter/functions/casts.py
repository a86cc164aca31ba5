"""Tolerant casts for text columns.

Spark 4 runs with ANSI mode on, where ``cast`` and ``to_timestamp`` raise
on malformed text. Raw extracts are messy (blank ages, ZIP+4 codes, junk
dates), so every parse here uses the ``try_`` forms: bad text becomes
null and the job keeps going. All helpers are JVM-side expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text layout of dates in the incident extracts.
INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: Column | str) -> Column:
    """Text -> int; blanks around digits are ignored, anything else -> null."""
    return _col(c).try_cast("int")


def to_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def parse_timestamp(c: Column | str, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """Text -> wall-clock timestamp (``timestamp_ntz``); malformed -> null.

    The text is read as a wall-clock time, independent of the session time
    zone (a local-time parse would shift times that fall in a daylight-saving
    gap of that zone). ``to_timestamp_ntz`` raises on malformed text under
    ANSI mode, so it only runs where ``try_to_timestamp`` (same pattern,
    same parser) accepted the text.
    """
    text = _col(c)
    pattern = F.lit(fmt)
    return F.when(F.try_to_timestamp(text, pattern).isNotNull(), F.to_timestamp_ntz(text, pattern))


def parse_money(c: Column | str) -> Column:
    """``'$41,234'`` -> 41234.0; text that is not a number -> null."""
    return F.regexp_replace(_col(c), r"[$,]", "").try_cast("double")
