"""All four questions from one pass over the extracts.

Q1, Q2 and Q4 all start from the de-duplicated union of the two incident
extracts, the most expensive step (a shuffle of every column). Run one by
one, each question repeats it. ``all_questions`` de-duplicates once,
writes the typed result to the shared folder (``session.materialize``) and
answers every question from that table; Q3 reads the older extract as the
question is posed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import materialize
from . import q1, q2, q3, q4
from .incidents import merge_extracts


def all_questions(extract_a: DataFrame, extract_b: DataFrame, stations: DataFrame,
                  revgeo: DataFrame, income: DataFrame, typed_a: DataFrame,
                  strategy: str = "auto") -> dict[str, DataFrame]:
    """Every question's answer, de-duplicating the extracts once."""
    merged = materialize(merge_extracts(extract_a, extract_b), "merged-incidents")
    return {
        "q1_top_months": q1.top_months(merged),
        "q2_time_of_day_string": q2.street_by_daypart_text(merged),
        "q2_time_of_day_int": q2.street_by_daypart_number(merged),
        "q3_income_extremes": q3.descent_extremes(typed_a, revgeo, income, strategy),
        "q4_station_distance": q4.station_distance(merged, stations, strategy),
    }
