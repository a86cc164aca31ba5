"""Time-of-day buckets for the ``HHmm`` text column.

Two semantics exist and give different answers on unpadded or invalid
values, so both are kept under their own names:

* ``daypart_text``   compares the text lexically (``'930'`` sorts after
  ``'2100'`` and lands in NIGHT); anything unmatched, null included, is
  ``OTHERWISE``.
* ``daypart_number`` reads the text as an integer (``'930'`` -> 930 ->
  MORNING); invalid times, null included, are ``UNKNOWN``.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket labels and their inclusive HHmm bounds.
MORNING = "MORNING"        # 0500 - 1159
AFTERNOON = "AFTERNOON"    # 1200 - 1659
EVENING = "EVENING"        # 1700 - 2059
NIGHT = "NIGHT"            # 2100 - 2359 and 0000 - 0459
TEXT_FALLBACK = "OTHERWISE"
NUMBER_FALLBACK = "UNKNOWN"

BUCKETS = [
    (MORNING, 500, 1159),
    (AFTERNOON, 1200, 1659),
    (EVENING, 1700, 2059),
]
NIGHT_LATE = (2100, 2359)
NIGHT_EARLY = (0, 459)


def _hhmm(n: int) -> str:
    return f"{n:04d}"


def daypart_text(c: Column | str) -> Column:
    return _text_by_name(c) if isinstance(c, str) else _daypart_text(c)


def daypart_number(c: Column | str) -> Column:
    return _number_by_name(c) if isinstance(c, str) else _daypart_number(c)


@cache
def _text_by_name(name: str) -> Column:
    return _daypart_text(F.col(name))


@cache
def _number_by_name(name: str) -> Column:
    return _daypart_number(F.col(name))


def _daypart_text(t: Column) -> Column:
    expr = None
    for label, lo, hi in BUCKETS:
        cond = (t >= _hhmm(lo)) & (t <= _hhmm(hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    night = (t >= _hhmm(NIGHT_LATE[0])) | (t <= _hhmm(NIGHT_EARLY[1]))
    return expr.when(night, NIGHT).otherwise(TEXT_FALLBACK)


def _daypart_number(c: Column) -> Column:
    t = c.try_cast("int")
    expr = None
    for label, lo, hi in BUCKETS:
        cond = t.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    night = t.between(*NIGHT_LATE) | t.between(*NIGHT_EARLY)
    return expr.when(night, NIGHT).otherwise(NUMBER_FALLBACK)
