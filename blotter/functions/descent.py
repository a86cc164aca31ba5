"""Victim-descent code -> label.

The table is data, not control flow: one map literal looked up per row
inside whole-stage codegen. A missing or null code yields ``OTHERWISE``.
Codes H and I share a label, so grouping by label can merge two codes.
"""

from __future__ import annotations

from functools import cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Descent codes and their labels.
DESCENT_LABELS = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "Hispanic/Latin/Mexican",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific Islander",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}
FALLBACK = "OTHERWISE"


@cache
def _lookup(items: tuple[tuple[str, str], ...]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(items)])


@cache
def _label_of(name: str, items: tuple[tuple[str, str], ...]) -> Column:
    return F.coalesce(F.try_element_at(_lookup(items), F.col(name)), F.lit(FALLBACK))


def descent_label(c: Column | str, labels: dict[str, str] | None = None) -> Column:
    items = tuple((DESCENT_LABELS if labels is None else labels).items())
    if isinstance(c, str):
        return _label_of(c, items)
    return F.coalesce(F.try_element_at(_lookup(items), c), F.lit(FALLBACK))
