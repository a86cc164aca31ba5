"""The query catalog: one entry per operator / question, ``(spark, sf_dir) -> DataFrame``.

Operator-level entries exercise one building block on a table that grows
with the data; question entries (``q1_`` .. ``q4_``) are the four
questions and their alternative routes (API, file format, join strategy).
Names, inputs and SQL counterparts are listed in ``plans/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.descent import descent_label
from ..operators import (bottom_k, firearm_with_coordinates, group_count, null_safe_condition,
                         null_safe_join, salted_join, sum_by_key, top_k, union_all, union_distinct,
                         where_equals, where_like, where_not_null)
from ..session import shared_dir
from ..sources import derived
from ..sources.files import csv_to_parquet, read_csv, read_parquet, write_csv
from ..sources.schemas import INCIDENTS_RAW, RAW_SCHEMAS
from ..sources.typed import typed_incidents
from ..streaming import convert_available
from . import extended, q1, q2, q3, q4
from .incidents import (merge_extracts, merged_incidents, merged_incidents_from_csv,
                        stage_extracts_as_csv)

Query = Callable[[SparkSession, str], DataFrame]


def _incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.incidents(spark, sf_dir)


# --- scans, sinks, parsing ------------------------------------------------

def csv_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_csv(derived.incidents_raw(spark, sf_dir), f"{shared_dir(spark, 'scan')}/incidents.csv")
    return typed_incidents(read_csv(spark, path, INCIDENTS_RAW))


def csv_scan_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files whose columns come in different orders, one with a column more, read as one table."""
    base = shared_dir(spark, "reordered")
    a, b = (derived.incidents_raw(spark, sf_dir, part) for part in ("a", "b"))
    paths = [write_csv(a.select(*reversed(a.columns)), f"{base}/a.csv"),
             write_csv(b.withColumn("note", F.lit("x")).select("note", *b.columns), f"{base}/b.csv")]
    return typed_incidents(read_csv(spark, paths, INCIDENTS_RAW))


def row_checksum(df: DataFrame) -> DataFrame:
    """(row_count, checksum): a sum over rows of the first 32 bits of a digest of each row's text."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("<null>")) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")).alias("checksum"))


def csv_to_parquet_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch conversion over every raw extract: rows and checksum of each converted table."""
    base = shared_dir(spark, "convert")
    written = {name: write_csv(make(spark, sf_dir), f"{base}/csv/{name}.csv")
               for name, make in derived.RAW.items()}
    out = csv_to_parquet(spark, list(written.values()), f"{base}/parquet")
    sums = [row_checksum(read_parquet(spark, out[at]).select(*RAW_SCHEMAS[name].names))
            .select(F.lit(name).alias("table_name"), "row_count", "checksum") for name, at in written.items()]
    return union_all(*sums)


def csv_to_parquet_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both extracts land as CSV folders; one available-now stream converts them."""
    base = shared_dir(spark, "landing")
    for part in ("a", "b"):
        write_csv(derived.incidents_raw(spark, sf_dir, part), f"{base}/in/incidents_{part}.csv")
    return convert_available(spark, f"{base}/in/*.csv", f"{base}/parquet", INCIDENTS_RAW,
                             checkpoint=f"{base}/checkpoint")


def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incidents(spark, sf_dir).select("dr_no", "date_occ")


def money_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.households(spark, sf_dir).select("household_id", "median_income")


# --- filters ----------------------------------------------------------------

def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return where_equals(_incidents(spark, sf_dir), "premis_desc", q2.STREET).select("dr_no", "time_occ")


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return where_not_null(_incidents(spark, sf_dir), "vict_descent").select("dr_no", "vict_descent")


def filter_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return where_like(derived.households(spark, sf_dir), "community", q3.CITY_PATTERN) \
        .select("household_id", "community")


def filter_range_nonzero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return firearm_with_coordinates(_incidents(spark, sf_dir)).select("dr_no", "weapon_cd", "lat", "lon")


# --- set operations, aggregates, ranking ----------------------------------

def union_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(derived.incidents_raw(spark, sf_dir, "a"), derived.incidents_raw(spark, sf_dir, "b"))


def union_distinct_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_distinct(derived.incidents_raw(spark, sf_dir, "a"),
                          derived.incidents_raw(spark, sf_dir, "b"))


def group_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_count(_incidents(spark, sf_dir), "area")


def reduce_by_key_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sum_by_key(_incidents(spark, sf_dir), "area", "weapon_cd", name="total")


def rank_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = derived.table(spark, sf_dir, "lineitem", "l_shipdate")
    return q1.top_months(li, date_col="l_shipdate")


def top_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hh = derived.households(spark, sf_dir).select("household_id", "zip", "median_income")
    return top_k(hh, "median_income", 3, ["household_id"])


def bottom_k_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hh = derived.households(spark, sf_dir).select("household_id", "zip", "median_income")
    return bottom_k(hh, "median_income", 3, ["household_id"])


def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _incidents(spark, sf_dir).select(descent_label("vict_descent").alias("descent"))
    return group_count(labelled, "descent")


# --- joins ----------------------------------------------------------------

def join_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident with the ZIP of its position; a position with many incidents is salted."""
    inc = _incidents(spark, sf_dir).select("dr_no", F.struct("lat", "lon").alias("spot")).filter("spot.lat is not null and spot.lon is not null")
    geo = derived.revgeo(spark, sf_dir).select(F.struct("lat", "lon").alias("at"), "zip")
    return salted_join(inc, geo, "spot", "at", salt_source="dr_no").select("dr_no", "zip")


def join_using(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents per ZIP, with its community; both sides are counted per position before they are joined."""
    inc = _incidents(spark, sf_dir).groupBy("lat", "lon").agg(F.count(F.lit(1)).alias("n"))
    geo = derived.revgeo(spark, sf_dir).groupBy("lat", "lon", "zip").agg(F.count(F.lit(1)).alias("m"))
    per_zip = inc.join(geo, ["lat", "lon"]).groupBy("zip").agg(F.sum(F.col("n") * F.col("m")).alias("count"))
    return per_zip.join(derived.income(spark, sf_dir).select("zip", "community"), "zip") \
        .select("zip", "community", "count")


def join_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of extract A with the time and area that extract B has for them, null weapon codes matching."""
    a = derived.incidents(spark, sf_dir, "a").select("dr_no", "weapon_cd", "premis_desc")
    b = derived.incidents(spark, sf_dir, "b").select("dr_no", "weapon_cd", "time_occ", "area")
    return null_safe_join(a, b, [("dr_no", "dr_no"), ("weapon_cd", "weapon_cd")])


def join_null_safe_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of extract A also present in extract B, null weapon codes matching.

    A left-semi join: each A row is kept once if any B row matches, so a key
    repeated on both sides never multiplies into all pairs.
    """
    a = derived.incidents(spark, sf_dir, "a").select("dr_no", "weapon_cd")
    b = derived.incidents(spark, sf_dir, "b").select("dr_no", "weapon_cd")
    cond = null_safe_condition(a, b, [("dr_no", "dr_no"), ("weapon_cd", "weapon_cd")])
    return a.join(b, cond, "left_semi")


# --- Q1 ------------------------------------------------------------------

def q1_df_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q1.top_months(merged_incidents(spark, sf_dir))


def q1_df_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 on the Parquet copies that the conversion made of the text files."""
    paths = stage_extracts_as_csv(spark, sf_dir)
    out = csv_to_parquet(spark, paths, f"{shared_dir(spark, 'converted')}/parquet")
    return q1.top_months(merge_extracts(*[read_parquet(spark, out[p]) for p in paths]))


def q1_df_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q1.top_months(merged_incidents_from_csv(spark, sf_dir))


def q1_sql_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q1.top_months_sql(spark, merged_incidents(spark, sf_dir))


def q1_sql_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q1.top_months_sql(spark, merged_incidents_from_csv(spark, sf_dir))


# --- Q2 ------------------------------------------------------------------

def q2_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q2.street_by_daypart_text(merged_incidents(spark, sf_dir))


def q2_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q2.street_by_daypart_number(merged_incidents(spark, sf_dir))


# --- Q3 (the older extract only, as the question is posed) -----------------

def _q3(side: Callable, strategy: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return side(derived.incidents(spark, sf_dir, "a"), derived.revgeo(spark, sf_dir),
                    derived.income(spark, sf_dir), strategy)
    return run


# --- Q4 ------------------------------------------------------------------

def _q4(strategy: str = "auto", filtered: bool = True, udf: bool = False, rows: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inc = merged_incidents(spark, sf_dir)
        st = derived.stations(spark, sf_dir)
        if rows:
            return q4.distance_rows(inc, st, strategy, filtered)
        if udf:
            return q4.station_distance_udf(inc, st, strategy, filtered)
        return q4.station_distance(inc, st, strategy, filtered)
    return run


QUERIES: dict[str, Query] = {
    "csv_scan_typed": csv_scan_typed,
    "csv_scan_reordered": csv_scan_reordered,
    "csv_to_parquet": csv_to_parquet_query,
    "csv_to_parquet_stream": csv_to_parquet_stream,
    "timestamp_parse": timestamp_parse,
    "money_parse": money_parse,
    "filter_equals": filter_equals,
    "filter_not_null": filter_not_null,
    "filter_like": filter_like,
    "filter_range_nonzero": filter_range_nonzero,
    "union_all": union_all_query,
    "union_distinct": union_distinct_query,
    "group_count": group_count_query,
    "reduce_by_key_sum": reduce_by_key_sum,
    "rank_per_group": rank_per_group,
    "top_k": top_k_query,
    "bottom_k": bottom_k_query,
    "decode_codes": decode_codes,
    "join_composite_key": join_composite_key,
    "join_using": join_using,
    "join_null_safe": join_null_safe,
    "join_null_safe_semi": join_null_safe_semi,
    "q1_top_months_df_parquet": q1_df_parquet,
    "q1_top_months_df_csv": q1_df_csv,
    "q1_top_months_df_converted": q1_df_converted,
    "q1_top_months_sql_parquet": q1_sql_parquet,
    "q1_top_months_sql_csv": q1_sql_csv,
    "q2_time_of_day_string": q2_string,
    "q2_time_of_day_int": q2_int,
    "q3_income_top": _q3(q3.descent_richest, "auto"),
    "q3_income_bottom": _q3(q3.descent_poorest, "auto"),
    "q3_income_top_broadcast": _q3(q3.descent_richest, "broadcast"),
    "q3_income_top_merge": _q3(q3.descent_richest, "merge"),
    "q3_income_top_shuffle_hash": _q3(q3.descent_richest, "shuffle_hash"),
    "q3_income_bottom_broadcast": _q3(q3.descent_poorest, "broadcast"),
    "q3_income_bottom_merge": _q3(q3.descent_poorest, "merge"),
    "q3_income_bottom_shuffle_hash": _q3(q3.descent_poorest, "shuffle_hash"),
    "q3_income_extremes": _q3(q3.descent_extremes, "auto"),
    "q4_distance_rows": _q4(rows=True),
    "q4_station_distance": _q4(),
    "q4_station_distance_unfiltered": _q4(filtered=False),
    "q4_station_distance_broadcast": _q4("broadcast"),
    "q4_station_distance_repartition": _q4("salted"),
    "q4_station_distance_udf": _q4(udf=True),
    **extended.QUERIES,
}
