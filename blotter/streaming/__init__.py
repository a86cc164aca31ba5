"""Structured Streaming routes: incremental conversion, event-time windows
with a side table, de-duplication of re-exported extracts, and answers kept
up to date. All are restartable and give each row its effect once."""

from .dedup import deduplicate_available
from .incremental import Answers, update_available
from .ingest import convert_available, start_conversion
from .windows import WindowCounts, count_available

__all__ = ["Answers", "WindowCounts", "convert_available", "count_available", "deduplicate_available", "start_conversion", "update_available"]
