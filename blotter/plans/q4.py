"""Q4: mean distance from firearm incidents to their area's police station.

Incidents with a firearm weapon code and a known position are joined to
the station of their area (``area`` = ``prec``), the ellipsoidal distance
is computed per row as a native expression, and per division the mean
distance and the number of incidents are reported, most incidents first.

Join routes (the physical strategy is the only difference):

* ``auto``        no hint: the optimizer, and at run time adaptive
                  execution, choose the join by bytes (a station table is
                  a dimension, so a broadcast) and split skewed partitions.
* ``broadcast``   one row per station key (``max_by``; a dict built from
                  the pairs would keep one too), broadcast if its data is
                  checked to be small, else as ``auto``.
* ``salted``      the shuffled join whose hot keys are salted, for a station
                  side too big to broadcast: there are few keys (one per
                  area), so a plain hash repartition would put each area,
                  possibly a third of all incidents, into one task.
* ``merge`` / ``shuffle_hash`` as in ``operators.joins``.

The aggregate is partial + final on ``division``: after the map side only
one row per division and task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import geodesic_km_udf, with_geodesic_km
from ..operators.aggregate import one_per_key
from ..operators.filters import firearm_with_coordinates
from ..operators.joins import ROWS_PER_SALT, join_with_strategy, salted_join

# Fixed value: reported distances are rounded to 1e-6 km (1 mm), below the
# formula's own accuracy, so results do not depend on summation order.
DISTANCE_DECIMALS = 6


def incidents_with_station(incidents: DataFrame, stations: DataFrame, strategy: str = "auto",
                           filtered: bool = True, area_col: str = "area",
                           rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Incidents (firearm, known position unless ``filtered=False``) joined to their station."""
    inc = firearm_with_coordinates(incidents) if filtered else incidents
    st = stations.select(F.col("prec").alias("_key"), "division", "y", "x")
    if strategy == "salted":
        # Salt on the whole incident row: many incidents of one area at the
        # same spot are still distinct rows and spread over the salts.
        inc = inc.select(F.col(area_col).alias("_key"), "lat", "lon",
                         F.hash(*[F.col(c) for c in inc.columns]).alias("_row"))
        st = st.withColumnRenamed("_key", "_skey")
        return salted_join(inc, st, "_key", "_skey", rows_per_salt, salt_source="_row").drop("_skey", "_row")
    inc = inc.select(F.col(area_col).alias("_key"), "lat", "lon")
    if strategy == "broadcast":
        st = one_per_key(st, "_key")
        return join_with_strategy(inc, st, ["_key"], strategy="broadcast")
    return join_with_strategy(inc, st, ["_key"], strategy=strategy)


def with_distance(joined: DataFrame, udf: bool = False) -> DataFrame:
    """Per-row distance; native staged expression, or the pandas UDF route."""
    rows = joined.select(F.col("lat").alias("crime_lat"), F.col("lon").alias("crime_lon"),
                         F.col("y").alias("station_lat"), F.col("x").alias("station_lon"),
                         "division")
    if udf:
        return rows.withColumn("distance", geodesic_km_udf("crime_lat", "crime_lon",
                                                           "station_lat", "station_lon"))
    return with_geodesic_km(rows, "crime_lat", "crime_lon", "station_lat", "station_lon", "distance")


def distance_rows(incidents: DataFrame, stations: DataFrame, strategy: str = "auto",
                  filtered: bool = True, udf: bool = False) -> DataFrame:
    """One row per incident with its station and the distance in km (rounded to 1 mm)."""
    rows = with_distance(incidents_with_station(incidents, stations, strategy, filtered), udf)
    return rows.withColumn("distance", F.round("distance", DISTANCE_DECIMALS))


def station_distance(incidents: DataFrame, stations: DataFrame, strategy: str = "auto",
                     filtered: bool = True, udf: bool = False) -> DataFrame:
    """Per division: mean incident-to-station distance and number of incidents, most first."""
    rows = with_distance(incidents_with_station(incidents, stations, strategy, filtered), udf)
    return (rows.groupBy("division")
                .agg(F.round(F.avg("distance"), DISTANCE_DECIMALS).alias("average_distance"),
                     F.count(F.lit(1)).alias("number_of_incidents"))
                .orderBy(F.col("number_of_incidents").desc(), "division"))


def station_distance_udf(incidents: DataFrame, stations: DataFrame,
                         strategy: str = "auto", filtered: bool = True) -> DataFrame:
    """Same answer with the distance in an Arrow-batched pandas UDF."""
    return station_distance(incidents, stations, strategy, filtered, udf=True)
