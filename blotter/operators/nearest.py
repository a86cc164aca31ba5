"""The k nearest sites of every point on the sphere, exact and without comparing all pairs.

Positions become unit vectors, so there are no poles and no 180th meridian
to treat: the straight distance of two vectors orders pairs as the distance
on the sphere does. Space is covered by cubic cells; a cell at level m is
2 / 2**m wide, and coarser cells are bit shifts of finer ones.

1. The starting level is the coarsest whose fullest cell holds at most
   ``crowd`` sites (counted for all levels in one aggregate).
2. Occupied cells, not points, look for sites in the 27 cells around them.
   Of a cell only the box that its points take up counts: the sphere cuts
   many cells near a corner, and those would never settle as whole cells.
   The k-th smallest *greatest* distance between box and site bounds every
   point's k-th nearest. If the bound is within the box's distance to the
   end of the block, no site outside can be nearer and the cell is settled;
   the others are merged into cells twice as wide and look again. Each
   round is an equi-join on cells whose k best rows are kept before they
   are shuffled.
3. A settled cell's candidates are the sites whose *smallest* distance to
   its box is within its bound. They come as arrays of about ``CHUNK``,
   dealt by key and position, as many sites may have one key; a
   point reads its cell's array in place, and only points whose cell has
   several arrays go through a ranking shuffle.

Points are reduced to distinct positions first and joined back at the end
with hot positions salted, so one spot holding a third of the points is no
bottleneck. Of sites in one position only the k smallest keys can matter
and stay. Distances are rounded to the millimetre before they are compared,
ties go to the smaller key.

Defined results: points or sites without a position (null, not a number,
latitude beyond 90) give no rows; repeated points get their rows each; with
fewer than k sites all are returned; without sites, nothing. A site key
that is null is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import ROWS_PER_SALT, salted_join

EARTH_KM = 6371.0088            # mean radius
FINEST = 20                     # cells of 12 m
CHUNK = 256
SLACK = 1e-9                    # of the radius, 6 mm: more than what distances are rounded by
DECIMALS = 6
AXES = ("x", "y", "z")
BOX = [f"{end}{a}" for a in AXES for end in ("lo", "hi")]


def _vector(lat: str, lon: str) -> list[Column]:
    a, o = F.radians(lat), F.radians(lon)
    return [(F.cos(a) * F.cos(o)).alias("x"), (F.cos(a) * F.sin(o)).alias("y"), F.sin(a).alias("z")]


def _known(lat: str, lon: str) -> Column:
    # Not a number is greater than any number.
    return (F.abs(F.col(lat)) <= 90) & (F.abs(F.col(lon)) <= 360)


def _cell(axis: str, level: int) -> Column:
    return F.floor((F.col(axis) + 1) * float(2 ** level) / 2).cast("bigint")


def _coarser(by: int, prefix: str) -> list[Column]:
    return [F.shiftright(f"f{a}", by).alias(f"{prefix}{a}") for a in AXES]


def _box() -> list[Column]:
    """The box that points take up."""
    return [c for a in AXES for c in (F.min(a).alias(f"lo{a}"), F.max(a).alias(f"hi{a}"))]


def _merged() -> list[Column]:
    """The box that boxes take up."""
    return [c for a in AXES for c in (F.min(f"lo{a}").alias(f"lo{a}"), F.max(f"hi{a}").alias(f"hi{a}"))]


def _squared(to_site: bool, level: int, greatest: bool) -> Column:
    """The squared distance of the box lo to hi and a site, or the cell n: the least or the greatest."""
    width, total = 2.0 / 2 ** level, F.lit(0.0)
    for a in AXES:
        lo, hi = F.col(f"lo{a}"), F.col(f"hi{a}")
        if not to_site:
            cell = F.col(f"n{a}") * width - 1
            apart = F.greatest(cell - hi, lo - cell - width, F.lit(0.0))
        elif greatest:
            apart = F.greatest(F.abs(F.col(a) - lo), F.abs(F.col(a) - hi))
        else:
            apart = F.greatest(lo - F.col(a), F.col(a) - hi, F.lit(0.0))
        total = total + apart * apart
    return total


def _reach(level: int) -> Column:
    """How far around the box every site is in one of the 27 cells."""
    width = 2.0 / 2 ** level
    return F.least(*[c for a in AXES for c in (F.col(f"lo{a}") + 1 - (F.col(f"u{a}") - 1) * width, (F.col(f"u{a}") + 2) * width - 1 - F.col(f"hi{a}"))])


def _around(units: DataFrame, columns: list[str]) -> DataFrame:
    """Every unit with each of the 27 cells around it as nx, ny, nz."""
    steps = F.array(*[F.struct(*[F.lit(s).cast("bigint").alias(a) for s, a in zip((i, j, k), AXES)])
                      for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])
    each = units.select(*columns, F.explode(steps).alias("step"))
    return each.select(*columns, *[(F.col(f"u{a}") + F.col(f"step.{a}")).alias(f"n{a}") for a in AXES])


def _start_level(sites: DataFrame, crowd: int) -> int:
    """The coarsest level whose fullest cell has at most ``crowd`` sites."""
    each = sites.select(F.explode(F.sequence(F.lit(1), F.lit(FINEST))).alias("level"), *[f"f{a}" for a in AXES])
    cell = [F.expr(f"shiftright(f{a}, {FINEST} - level)") for a in AXES]
    full = each.groupBy("level", *cell).agg(F.count(F.lit(1)).alias("n")).groupBy("level").agg(F.max("n").alias("n"))
    return min([r["level"] for r in full.filter(F.col("n") <= crowd).collect()], default=FINEST)


def _settle(cells: DataFrame, sites: DataFrame, start: int, k: int) -> list[tuple[int, DataFrame, DataFrame]]:
    """Per level that settles some: (level, its cells with their box and bound, the finest cells they settle)."""
    unit, near = [f"u{a}" for a in AXES], [f"n{a}" for a in AXES]
    whole = [*unit, *BOX]
    out, pending = [], cells
    for level in range(start, -1, -1):
        by = start - level
        units = pending.groupBy(*_coarser(by, "u")).agg(*_merged())
        hits = _around(units, whole).join(sites.select(*_coarser(by, "n"), *AXES), near).select(*whole, F.sqrt(_squared(True, level, True)).alias("far"))
        best = hits.withColumn("nth", F.row_number().over(Window.partitionBy(*unit).orderBy("far"))).filter(F.col("nth") <= k)
        bounds = best.groupBy(*whole).agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("bound"))
        if level:
            done = bounds.filter((F.col("n") == k) & (F.col("bound") + SLACK <= _reach(level))).select(*whole, "bound")
        else:
            # The widest block holds every site: with fewer than k all of them are near.
            done = bounds.select(*whole, F.when(F.col("n") == k, F.col("bound")).otherwise(4.0).alias("bound"))
        done = materialize(done, "nearest-settled")
        named = pending.select("*", *_coarser(by, "u"))
        settled = materialize(named.join(done.select(*unit), unit, "left_semi"), "nearest-cells")
        out.append((level, done, settled))
        pending = materialize(named.join(done.select(*unit), unit, "left_anti").select(*[f"f{a}" for a in AXES], *BOX), "nearest-pending")
        if pending.isEmpty():
            break
    return out


def k_nearest(points: DataFrame, sites: DataFrame, k: int, site_key: str, lat: str = "lat", lon: str = "lon", site_lat: str = "lat", site_lon: str = "lon",
              crowd: int = 32, rows_per_salt: int = ROWS_PER_SALT, chunk: int = CHUNK) -> DataFrame:
    """Every row of ``points`` with each of its ``k`` nearest sites: ``near_key``, ``near_km`` and ``near_rank`` (from 1)."""
    if k < 1:
        raise ValueError("k must be at least 1")
    clash = {"near_key", "near_km", "near_rank"} & set(points.columns)
    if clash:
        raise ValueError(f"points have the columns {sorted(clash)}")
    where = sites.filter(_known(site_lat, site_lon)).select(F.col(site_key).alias("key"), F.col(site_lat).alias("lat"), F.col(site_lon).alias("lon")).filter("key IS NOT NULL")
    nth = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("key"))
    where = where.distinct().withColumn("nth", nth).filter(F.col("nth") <= k).select("key", *_vector("lat", "lon"))
    where = materialize(where.select("key", *AXES, *[_cell(a, FINEST).alias(f"f{a}") for a in AXES]), "nearest-sites")
    start = _start_level(where, crowd)
    where = where.select("key", *AXES, *_coarser(FINEST - start, "f"))
    spots = points.filter(_known(lat, lon)).select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).distinct().select("lat", "lon", *_vector("lat", "lon"))
    spots = materialize(spots.select("*", *[_cell(a, start).alias(f"f{a}") for a in AXES]), "nearest-spots")
    unit, fine = [f"u{a}" for a in AXES], [f"f{a}" for a in AXES]
    cells = materialize(spots.groupBy(*fine).agg(*_box()), "nearest-pending")
    tables, units = [], []
    for level, done, settled in _settle(cells, where, start, k):
        block = _around(done, [*unit, *BOX, "bound"]).filter(F.sqrt(_squared(False, level, False)) <= F.col("bound") + SLACK)
        found = block.join(where.select("key", *AXES, *_coarser(start - level, "n")), [f"n{a}" for a in AXES])
        found = found.filter(F.sqrt(_squared(True, level, False)) <= F.col("bound") + SLACK)
        tables.append(found.select(F.lit(level).alias("level"), *unit, "key", *AXES))
        units.append(settled.select(*fine, F.lit(level).alias("level"), *unit))
    unit = ["level", *unit]
    candidates, units_of = tables[0], units[0]
    for t, u in zip(tables[1:], units[1:]):
        candidates, units_of = candidates.unionByName(t), units_of.unionByName(u)
    candidates = materialize(candidates, "nearest-candidates")
    sizes = candidates.groupBy(*unit).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    arrays = (candidates.join(sizes, unit).withColumn("nth", F.pmod(F.xxhash64("key", *AXES), F.col("chunks")))
              .groupBy(*unit, "chunks", "nth").agg(F.collect_list(F.struct("key", F.struct(*AXES).alias("at"))).alias("sites")))
    placed = spots.join(units_of, fine).join(arrays, unit)

    def km(c: Column) -> Column:
        chord = F.sqrt(sum((F.pow(F.col(a) - c["at"][a], F.lit(2)) for a in AXES), F.lit(0.0)))
        return F.round(2 * EARTH_KM * F.asin(F.least(chord / 2, F.lit(1.0))), DECIMALS)

    best = F.slice(F.array_sort(F.transform("sites", lambda c: F.struct(km(c).alias("km"), c["key"].alias("key")))), 1, k)
    each = placed.select("lat", "lon", "chunks", F.posexplode(best).alias("nth", "s")).select("lat", "lon", "chunks", "nth", "s.km", "s.key")
    one = each.filter("chunks = 1").select("lat", "lon", "key", "km", (F.col("nth") + 1).alias("rank"))
    rank = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("km", "key"))
    more = each.filter("chunks > 1").withColumn("rank", rank).filter(F.col("rank") <= k).select("lat", "lon", "key", "km", "rank")
    near = one.unionByName(more).select(F.struct("lat", "lon").alias("_at"), F.col("key").alias("near_key"), F.col("km").alias("near_km"), F.col("rank").cast("int").alias("near_rank"))
    known = points.filter(_known(lat, lon)).withColumn("_spot", F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")))
    # Repeated rows of a hot position are spread by what else tells them apart.
    return salted_join(known, near, "_spot", "_at", rows_per_salt).drop("_spot", "_at")
