"""Q3: victim descent in the richest and poorest ZIP codes of the city.

1. Income rows of the city (community LIKE '%Los Angeles (%') with a known
   income; the k highest and k lowest incomes (ties broken by ZIP) give
   at most k ZIPs per side.
2. Geocoding rows of those ZIPs only (a semi-join).
3. Incidents with a known descent are matched to the geocoding rows on
   exact (lat, lon) and counted per (ZIP, descent code). Duplicate
   coordinates in the geocoding table fan out, as an inner join does.
4. The ZIP list is joined back USING zip and the code is labelled.

How step 3 runs is the ``strategy``:

* ``auto``: both sides are first reduced by a partial aggregate (incidents
  to one row per (lat, lon, code) with a count, geocoding to one row per
  (lat, lon, zip) with a multiplicity), then joined on (lat, lon) without a
  hint and summed as count x multiplicity; the optimizer, and at run time
  adaptive execution, choose the join by bytes. A coordinate that holds a
  third of all incidents is collapsed on the map side before any shuffle,
  and no pairs within a hot coordinate are emitted.
* ``merge`` / ``shuffle_hash``: the same with that join.
* ``broadcast``: the selected geocoding rows are broadcast if their data is
  checked to be small, and the incidents are counted right after the join;
  beyond the bound as ``auto``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.descent import descent_label
from ..operators.filters import where_like, where_not_null
from ..operators.joins import DEFAULT_MAX_BROADCAST_BYTES, checked_broadcast, join_with_strategy
from ..operators.topk import bottom_k, top_k

# The city's community pattern and the number of ZIPs per side.
CITY_PATTERN = "%Los Angeles (%"
EXTREME_ZIPS = 3
STRATEGIES = ("auto", "broadcast", "merge", "shuffle_hash")


def city_income(income: DataFrame) -> DataFrame:
    """Income rows of the city's own communities."""
    return where_like(income, "community", CITY_PATTERN)


def richest_zips(income: DataFrame, k: int = EXTREME_ZIPS) -> DataFrame:
    """The ``k`` ZIPs of the city with the highest income (at most ``k`` rows)."""
    return top_k(city_income(income), "median_income", k, ["zip"]).select("zip")


def poorest_zips(income: DataFrame, k: int = EXTREME_ZIPS) -> DataFrame:
    """The ``k`` ZIPs of the city with the lowest known income (at most ``k`` rows)."""
    return bottom_k(city_income(income), "median_income", k, ["zip"]).select("zip")


def victims_per_zip(incidents: DataFrame, revgeo: DataFrame, zips: DataFrame,
                    strategy: str = "auto", max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Count of incidents per (zip, vict_descent) inside the given ZIPs."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown join strategy {strategy!r}; one of {STRATEGIES}")
    victims = where_not_null(incidents, "vict_descent").select("lat", "lon", "vict_descent")
    geo = revgeo.select("lat", "lon", "zip").join(zips.select("zip").distinct(), "zip", "left_semi")
    geo_points = geo.groupBy("lat", "lon", "zip").agg(F.count(F.lit(1)).alias("_m"))
    small = checked_broadcast(geo_points, max_bytes) if strategy == "broadcast" else None
    if small is not None:
        return victims.join(small, ["lat", "lon"]).groupBy("zip", "vict_descent").agg(F.sum("_m").alias("count"))
    per_point = victims.groupBy("lat", "lon", "vict_descent").agg(F.count(F.lit(1)).alias("_n"))
    joined = join_with_strategy(per_point, geo_points, ["lat", "lon"], strategy="auto" if strategy == "broadcast" else strategy)
    return (joined.groupBy("zip", "vict_descent")
                  .agg(F.sum(F.col("_n") * F.col("_m")).alias("count")))


def _labelled(zips: DataFrame, per_zip: DataFrame, extra: list[str]) -> DataFrame:
    out = zips.join(per_zip, "zip")
    return (out.select(*extra, "zip",
                       F.col("vict_descent").alias("descent_code"),
                       descent_label("vict_descent").alias("descent"),
                       "count")
               .orderBy(*extra, "zip", F.col("count").desc()))


def descent_in_zips(incidents: DataFrame, revgeo: DataFrame, zips: DataFrame,
                    strategy: str = "auto") -> DataFrame:
    """Victim-descent counts, labelled, for the given ZIPs."""
    return _labelled(zips, victims_per_zip(incidents, revgeo, zips, strategy), [])


def descent_richest(incidents: DataFrame, revgeo: DataFrame, income: DataFrame,
                    strategy: str = "auto", k: int = EXTREME_ZIPS) -> DataFrame:
    """Q3 for the richest ZIPs."""
    return descent_in_zips(incidents, revgeo, richest_zips(income, k), strategy)


def descent_poorest(incidents: DataFrame, revgeo: DataFrame, income: DataFrame,
                    strategy: str = "auto", k: int = EXTREME_ZIPS) -> DataFrame:
    """Q3 for the poorest ZIPs."""
    return descent_in_zips(incidents, revgeo, poorest_zips(income, k), strategy)


def descent_extremes(incidents: DataFrame, revgeo: DataFrame, income: DataFrame,
                     strategy: str = "auto", k: int = EXTREME_ZIPS) -> DataFrame:
    """Both sides from one pass over the incidents, tagged by ``side``."""
    zips = (richest_zips(income, k).withColumn("side", F.lit("richest"))
            .unionByName(poorest_zips(income, k).withColumn("side", F.lit("poorest"))))
    return _labelled(zips, victims_per_zip(incidents, revgeo, zips, strategy), ["side"])
