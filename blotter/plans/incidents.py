"""Building the incident table the questions run on.

The incidents arrive as two overlapping extracts (an older file and a
newer one that re-exports part of the older period). The questions read
their union with exact duplicates removed, typed afterwards, as the
raw rows are what the extracts hold.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.sets import union_distinct
from ..session import shared_dir
from ..sources import derived
from ..sources.files import read_csv, write_csv
from ..sources.schemas import INCIDENTS_RAW
from ..sources.typed import typed_incidents


def merge_extracts(*raw: DataFrame) -> DataFrame:
    """Whole-row de-duplicated union of raw extracts, then typed."""
    return typed_incidents(union_distinct(*raw))


def merged_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_extracts(derived.incidents_raw(spark, sf_dir, "a"),
                          derived.incidents_raw(spark, sf_dir, "b"))


def stage_extracts_as_csv(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write both raw extracts as CSV files in the shared folder.

    This reproduces the text files the questions start from; each call
    writes to a fresh folder, so concurrent runs never share files.
    """
    base = shared_dir(spark, "incident-extracts")

    def stage(part: str) -> str:
        return write_csv(derived.incidents_raw(spark, sf_dir, part), f"{base}/incidents_{part}.csv")

    with ThreadPoolExecutor(max_workers=2) as pool:     # two independent write jobs
        return list(pool.map(stage, ("a", "b")))


def read_extracts_csv(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    return [read_csv(spark, p, INCIDENTS_RAW) for p in paths]


def merged_incidents_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_extracts(*read_extracts_csv(spark, stage_extracts_as_csv(spark, sf_dir)))
