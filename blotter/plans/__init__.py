"""The four questions, their alternative routes, and the query catalog."""

from . import q1, q2, q3, q4
from .incidents import merge_extracts, merged_incidents, merged_incidents_from_csv

__all__ = ["merge_extracts", "merged_incidents", "merged_incidents_from_csv", "q1", "q2", "q3", "q4"]
