"""Scans, sinks, declared schemas, the typed step and the domain extracts."""

from . import derived, schemas
from .files import csv_to_parquet, parquet_name, read_csv, read_parquet, write_csv, write_parquet
from .tables import drop_table, read_table, write_bucketed, write_partitioned
from .typed import (typed, typed_households, typed_incidents, typed_income, typed_revgeo,
                    typed_stations)

__all__ = [
    "csv_to_parquet", "derived", "drop_table", "parquet_name", "read_csv", "read_parquet", "read_table", "schemas",
    "typed", "typed_households", "typed_incidents", "typed_income", "typed_revgeo",
    "typed_stations", "write_bucketed", "write_csv", "write_parquet", "write_partitioned",
]
