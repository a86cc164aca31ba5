"""Catalog queries of the place, time, change and stream operators, on tables that grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (asof_join, bag_difference, cube, exact_percentiles, interval_join, islands, k_nearest, keyed_difference, nonzero, overlap_join, rollup)
from ..operators import sketches
from ..session import materialize, shared_dir
from ..sources import derived
from ..sources.files import write_csv
from ..sources.schemas import INCIDENTS_RAW
from ..sources.tables import read_table, write_bucketed, write_partitioned
from ..streaming import count_available, deduplicate_available, update_available
from . import q4
from .incidents import merged_incidents

HOUR, DAY = 3600, 86400
# Fixed values of the derived tables (FIXTURES.md section 3).
FIRST_EVENT_DAY = 1704067200    # 2024-01-01
DELTA_DAYS = 6


# --- derived tables -------------------------------------------------------

def _area(key: str):
    return (F.col(key) % 27 + 1).cast("int").alias("area")


def duties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(period_id, area, on_at, off_at): a duty period per line item."""
    li = derived.table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_shipdate")
    li = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("period_id"), _area("l_suppkey"), "l_quantity",
                   F.expr("l_shipdate - make_dt_interval(0, CAST(l_partkey % 36 AS int))").alias("on_at"))
    return li.select("period_id", "area", "on_at", F.expr("on_at + make_dt_interval(0, CAST(l_quantity AS int))").alias("off_at"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(area, read_at, reading_id, level): a reading per line item."""
    li = derived.table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_shipdate")
    return li.select(_area("l_suppkey"), F.col("l_shipdate").alias("read_at"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("reading_id"), F.col("l_quantity").alias("level"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(visit_id, area, came_at, left_at): a visit of one to five hours per order."""
    o = derived.table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return o.select(F.col("o_orderkey").alias("visit_id"), _area("o_custkey"), F.col("o_orderdate").alias("came_at"),
                    F.expr("o_orderdate + make_dt_interval(0, CAST(o_orderkey % 5 + 1 AS int))").alias("left_at"))


def revised_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract B exported again: some premises corrected, some rows twice."""
    b = derived.incidents_raw(spark, sf_dir, "b")
    number = F.col("dr_no").cast("bigint")
    b = b.withColumn("premis_desc", F.when(number % 10 == 0, F.lit("STREET")).otherwise(F.col("premis_desc")))
    return b.withColumn("_i", F.explode(F.sequence(F.lit(1), F.when(number % 31 == 0, 2).otherwise(1)))).drop("_i")


def event_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, event_type, ts, delta): events and the delta they arrive in, most hours late, some days."""
    e = derived.table(spark, sf_dir, "events", "event_id", "event_type", "ts")
    second = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")) * DAY + F.hour("ts") * HOUR + F.minute("ts") * 60 + F.floor(F.second("ts"))
    late = F.col("event_id") * 7 % 11 * HOUR + F.when(F.col("event_id") % 50 == 0, 6 * DAY).otherwise(0)
    return e.withColumn("delta", F.floor((second + late - FIRST_EVENT_DAY) / (DELTA_DAYS * DAY)).cast("int"))


# --- place and time -------------------------------------------------------

def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.incidents(spark, sf_dir).select("dr_no", "lat", "lon").filter(nonzero("lat", "lon"))


def nearest_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three stations nearest to every incident."""
    out = k_nearest(_placed(spark, sf_dir), derived.stations(spark, sf_dir), 3, "prec", site_lat="y", site_lon="x")
    return out.select("dr_no", "near_rank", F.col("near_key").alias("prec"), "near_km")


def nearest_geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ZIP of the geocoded position nearest to every incident."""
    out = k_nearest(_placed(spark, sf_dir), derived.revgeo(spark, sf_dir), 1, "zip")
    return out.select("dr_no", F.col("near_key").alias("zip"), "near_km")


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.incidents(spark, sf_dir).select("dr_no", "area", "date_occ")


def join_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident with each duty period of its area that it falls in."""
    # Written first: the join reads them twice and tests their times often, which would be parsed from text each time.
    return interval_join(materialize(_dated(spark, sf_dir), "interval-points"), duties(spark, sf_dir), "date_occ", "on_at", "off_at", ["area"]).select("dr_no", "area", "period_id")


def join_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visit with each duty period of its area that it overlaps."""
    return overlap_join(visits(spark, sf_dir), duties(spark, sf_dir), "came_at", "left_at", "on_at", "off_at", ["area"]).select("visit_id", "area", "period_id")


def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every incident with its area's latest reading."""
    return asof_join(_dated(spark, sf_dir), readings(spark, sf_dir), ["area"], "date_occ", "read_at", ["reading_id"], bucket=30 * DAY)


def gaps_and_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of an area's incidents no more than three days apart."""
    return islands(_dated(spark, sf_dir), ["area"], "date_occ", 3 * DAY).select("area", "island", "start", "end", "n")


# --- groups ---------------------------------------------------------------

def rollup_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents and sums of weapon codes per year, month and area, and every total over them."""
    inc = derived.incidents(spark, sf_dir).select(F.year("date_occ").alias("year"), F.month("date_occ").alias("month"), "area", F.col("weapon_cd").cast("bigint").alias("weapon_cd"))
    return rollup(inc, ["year", "month", "area"], ["weapon_cd"])


def cube_premises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents per premise and descent, and every total over either."""
    return cube(derived.incidents(spark, sf_dir).select("premis_desc", "vict_descent"), ["premis_desc", "vict_descent"])


def percentile_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and 95th percentile of the distance to the station, per division."""
    rows = q4.distance_rows(merged_incidents(spark, sf_dir), derived.stations(spark, sf_dir)).select("division", "distance")
    out = exact_percentiles(rows, ["division"], "distance", [0.5, 0.95], interpolate=False)
    return out.select("division", "n", "share", "percentile")


def sketches_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per year, sketches stored by month and merged: whether distinct parts and median price are as near the exact ones as stated."""
    li = derived.table(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice", "l_shipdate")
    li = li.select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), "l_partkey", "l_extendedprice")
    stored = materialize(sketches.sketch(li, ["year", "month"], "l_partkey", "l_extendedprice"), "month-sketches")
    guess = sketches.estimate(sketches.merge(stored, ["year"]), [0.5]).select("year", "distinct_estimate", F.col("quantile_estimates")[0].alias("median"))
    guess = materialize(guess, "year-estimates")
    exact = li.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_partkey").alias("n_distinct"))
    price = F.col("l_extendedprice")
    ranks = li.join(guess, "year").groupBy("year", "distinct_estimate").agg(F.avg((price < F.col("median")).cast("double")).alias("below"), F.avg((price <= F.col("median")).cast("double")).alias("upto"))
    near = F.abs(F.col("distinct_estimate") - F.col("n_distinct")) <= F.greatest(F.lit(0.5), sketches.DISTINCT_ERROR * F.col("n_distinct"))
    return exact.join(ranks, "year").select("year", "n", "n_distinct", near.alias("distinct_within"),
                                            ((F.col("below") <= 0.5 + sketches.RANK_ERROR) & (F.col("upto") >= 0.5 - sketches.RANK_ERROR)).alias("median_within"))


# --- layout ---------------------------------------------------------------

def layout_bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items and their quantity per incident, from two tables bucketed alike."""
    inc = write_bucketed(derived.incidents(spark, sf_dir).select("dr_no", "area"), "incidents", ["dr_no"], 16)
    items = derived.table(spark, sf_dir, "lineitem", "l_orderkey", "l_quantity").withColumnRenamed("l_orderkey", "dr_no")
    items = write_bucketed(items, "items", ["dr_no"], 16)
    per = read_table(spark, items).groupBy("dr_no").agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    return read_table(spark, inc).join(per.hint("merge"), "dr_no").select("dr_no", "area", "n_items", "quantity")


def layout_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents per day of the areas whose station's division ends in 3, from a table partitioned by area."""
    inc = derived.incidents(spark, sf_dir).select("dr_no", F.to_date("date_occ").alias("day"), "area")
    inc = read_table(spark, write_partitioned(inc, "incidents_by_area", ["area"]))
    st = derived.stations(spark, sf_dir).filter("division LIKE '%3'").select(F.col("prec").alias("area"), "division")
    return inc.join(F.broadcast(st), "area").groupBy("division", "day").agg(F.count(F.lit(1)).alias("n"))


# --- versions -------------------------------------------------------------

def difference_bag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the revised extract B has more or fewer of than extract B."""
    return bag_difference(derived.incidents_raw(spark, sf_dir, "b"), revised_extract(spark, sf_dir))


def difference_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, deletes and updates from extract A to the revised extract B."""
    out = keyed_difference(derived.incidents_raw(spark, sf_dir, "a"), revised_extract(spark, sf_dir), ["dr_no"])
    return out.select("action", "dr_no", "premis_desc", "date_occ")


# --- streams --------------------------------------------------------------

def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type and day from deltas that arrive one by one, each in a stream restarted for it."""
    base, events = shared_dir(spark, "stream-windows"), event_deltas(spark, sf_dir)
    schema = events.drop("delta").schema
    counts = None
    for (delta,) in sorted(events.select("delta").distinct().collect()):
        events.filter(F.col("delta") == delta).drop("delta").write.parquet(f"{base}/in/{delta:06d}")
        counts = count_available(spark, f"{base}/in/*", base, schema, "ts", ["event_type"], DAY, DAY)
    if counts is None:
        return spark.createDataFrame([], "event_type string, window_start bigint, state string, n bigint")
    aside = counts.aside().withColumn("day", F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * DAY)
    aside = aside.groupBy("event_type", F.col("day").alias("window_start"), F.col("why").alias("state")).agg(F.count(F.lit(1)).alias("n"))
    done = [df.select("event_type", "window_start", F.lit(name).alias("state"), "n") for df, name in ((counts.closed(), "closed"), (counts.open(), "open"))]
    return done[0].unionByName(done[1]).unionByName(aside)


def _arriving(spark: SparkSession, sf_dir: str, base: str, run) -> object:
    """Extract A arrives and is taken in; then B and A once more, by a restarted stream."""
    write_csv(derived.incidents_raw(spark, sf_dir, "a"), f"{base}/in/1")
    run()
    write_csv(derived.incidents_raw(spark, sf_dir, "b"), f"{base}/in/2")
    write_csv(derived.incidents_raw(spark, sf_dir, "a"), f"{base}/in/3")
    return run()


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct rows of re-exported extracts."""
    base = shared_dir(spark, "stream-dedup")
    return _arriving(spark, sf_dir, base, lambda: deduplicate_available(spark, f"{base}/in/*", f"{base}/out", INCIDENTS_RAW, f"{base}/state"))


def _answers(spark: SparkSession, sf_dir: str):
    base = shared_dir(spark, "answers")
    return _arriving(spark, sf_dir, base, lambda: update_available(spark, f"{base}/in/*", base, INCIDENTS_RAW, derived.stations(spark, sf_dir)))


def incremental_q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).top_months()


def incremental_q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).street_by_daypart()


def incremental_q4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir).station_distance()


QUERIES = {f.__name__: f for f in (nearest_stations, nearest_geocode, join_interval, join_overlap, join_asof, gaps_and_islands, rollup_months, cube_premises,
                                   percentile_distance, sketches_merged, layout_bucketed_join, layout_partition_pruned, difference_bag, difference_keyed, stream_windows, stream_dedup, incremental_q1, incremental_q2, incremental_q4)}
