"""Distance on the WGS-84 ellipsoid as native column expressions.

The iterative inverse solution (Vincenty 1975), unrolled: each iteration is
a staged projection, so it stays inside whole-stage codegen instead of
calling a per-row Python solver. ``ITERATIONS`` bring all but nearly
antipodal pairs to well under 1 mm; a pair that has not converged gives
null rather than a wrong number. Same point -> 0.0; any null input -> null.

``geodesic_km_udf`` is the same solution as an Arrow-batched pandas UDF,
kept for the UDF route of the distance query.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS-84 semi-major axis (km) and flattening.
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563
WGS84_B_KM = WGS84_A_KM * (1 - WGS84_F)

ITERATIONS = 6
# Radians of longitude that the last step moved: who moves no more than that
# in the last of so few steps is less than a twentieth of it, 0.3 mm, from the end.
CONVERGED = 1e-9


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


LEVELS = 10             # nested SELECTs in a statement: the analyzer needs several rounds for each


@cache
def _solution(lat1: str, lon1: str, lat2: str, lon2: str, out: str, kept: tuple[str, ...],
              flattening: float, axis_km: float, iterations: int, converged: float) -> tuple[str, ...]:
    """The solution as statements over ``{rows}``, each on the result of the one before.

    They are nested SELECTs, each of which names what the next one uses more
    than once; analysing a few statements is several times as fast as as
    many ``withColumns`` calls. No step divides and no step's value is ever
    null (an unknown coordinate is not a number until the last step): both
    would add branches to the generated method, which the JVM interprets
    for ever once it is over 8,000 bytes.

    Where the textbook divides, products do: the azimuth at the equator comes
    from its angle, and the middle of the line only occurs times the squared
    cosine of that azimuth, which is its denominator.
    """
    f, b = flattening, axis_km * (1 - flattening)
    second = (axis_km ** 2 - b ** 2) / b ** 2
    quoted = lambda n: f"`{n}`"
    known = lambda n: f"coalesce({quoted(n)}, double('NaN'))"
    # Spark takes the result of these for one that may be null; it never is.
    of = lambda call: f"coalesce({call}, 0D)"
    levels = [
        {"_u1": of(f"atan({1 - f!r}D * {of(f'tan(radians({known(lat1)}))')})"), "_u2": of(f"atan({1 - f!r}D * {of(f'tan(radians({known(lat2)}))')})"),
         "_l": f"{of(f'radians({known(lon2)})')} - {of(f'radians({known(lon1)})')}"},
        {"_s1": of("sin(_u1)"), "_c1": of("cos(_u1)"), "_s2": of("sin(_u2)"), "_c2": of("cos(_u2)"), "_x0": "_l"},
        {"_ss": "_s1 * _s2", "_cc": "_c1 * _c2", "_cs": "_c1 * _s2", "_sc": "_s1 * _c2"},
    ]
    n = iterations - 1
    # What a level's expressions share is found by the code generator.
    for k in range(iterations):
        z, ca = f"(_cs - _sc * _cx{k})", f"(1D - _sa{k} * _sa{k})"
        q = f"({f / 16!r}D * ({4 + 4 * f!r}D - {3 * f!r}D * {ca}))"
        levels += [
            {f"_y{k}": f"_c2 * {of(f'sin(_x{k})')}", f"_cx{k}": of(f"cos(_x{k})")},
            # The sine and cosine of the line's angle, and the sine of its azimuth at the equator.
            {f"_sin{k}": of(f"sqrt(_y{k} * _y{k} + {z} * {z})"), f"_cos{k}": f"_ss + _cc * _cx{k}", f"_sa{k}": f"_c1 * {of(f'sin(atan2(_y{k}, {z}))')}"},
        ]
        if k < n:
            levels += [
                {f"_p{k}": f"{q} * (_cos{k} * {ca} - 2D * _ss)", f"_k{k}": f"{q} * {ca}"},
                {f"_x{k + 1}": f"_l + (1D - _k{k}) * {f!r}D * _sa{k} * ({of(f'atan2(_sin{k}, _cos{k})')}"
                               f" + _sin{k} * (_p{k} + _cos{k} * (2D * _p{k} * _p{k} - _k{k} * _k{k})))"},
            ]
    w = f"({second / 1024!r}D * (256D + _u * (-128D + _u * (74D - 47D * _u))))"
    levels += [
        {"_ca": f"1D - _sa{n} * _sa{n}", "_u": f"{second!r}D * (1D - _sa{n} * _sa{n})"},
        {"_bm": f"{w} * (_cos{n} * _ca - 2D * _ss)", "_bb": f"{w} * _ca"},
        {"_d": f"_sin{n} * (_bm + 0.25D * (_cos{n} * (2D * _bm * _bm - _bb * _bb)"
               f" - {1 / 6!r}D * _bm * (4D * _sin{n} * _sin{n} - 3D) * (4D * _bm * _bm - 3D * _bb * _bb)))"},
    ]
    statements = []
    for start in range(0, len(levels), LEVELS):
        source = "{rows}"
        for level in levels[start:start + LEVELS]:
            source = f"(SELECT *, {', '.join(f'{e} AS {name}' for name, e in level.items())} FROM {source})"
        statements.append(f"SELECT * FROM {source}")
    # A difference that is not a number is greater than any bound: null.
    km = (f"if(abs(_x{n} - _x{n - 1}) <= {converged!r}D, {b!r}D * (1D + _u * {1 / 16384!r}D * (4096D + _u * (-768D + _u * (320D - 175D * _u))))"
          f" * ({of(f'atan2(_sin{n}, _cos{n})')} - _d), NULL) AS {quoted(out)}")
    return (*statements, f"SELECT {', '.join([*(quoted(k) for k in kept if k != out), km])} FROM {{rows}}")


def with_geodesic_km(df: DataFrame, lat1: str, lon1: str, lat2: str, lon2: str,
                     out: str = "distance") -> DataFrame:
    """``df`` plus the distance column (column names starting with ``_`` must not be among its own).

    Every quantity is computed once per row and referenced by name, so the
    expression trees stay small and the optimizer keeps the steps as
    separate projections fused by whole-stage codegen.
    """
    for statement in _solution(lat1, lon1, lat2, lon2, out, tuple(df.columns), WGS84_F, WGS84_A_KM, ITERATIONS, CONVERGED):
        df = df.sparkSession.sql(statement, rows=df)
    return df


def geodesic_km_numpy(lat1, lon1, lat2, lon2):
    """The same solution on numpy arrays (used inside the pandas UDF); NaN where it has not converged."""
    f = WGS84_F
    u1, u2 = (np.arctan((1 - f) * np.tan(np.radians(v))) for v in (lat1, lat2))
    s1, c1, s2, c2 = np.sin(u1), np.cos(u1), np.sin(u2), np.cos(u2)
    first = x = np.radians(lon2) - np.radians(lon1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for step in range(ITERATIONS):
            sx, cx = np.sin(x), np.cos(x)
            sin = np.hypot(c2 * sx, c1 * s2 - s1 * c2 * cx)
            cos = s1 * s2 + c1 * c2 * cx
            angle = np.arctan2(sin, cos)
            sa = np.where(sin == 0, 0.0, c1 * c2 * sx / sin)
            ca = 1 - sa * sa
            m = np.where(ca < 1e-15, 0.0, cos - 2 * s1 * s2 / ca)
            k = f / 16 * ca * (4 + f * (4 - 3 * ca))
            if step < ITERATIONS - 1:
                was, x = x, first + (1 - k) * f * sa * (angle + k * sin * (m + k * cos * (2 * m * m - 1)))
    u = ca * (WGS84_A_KM ** 2 - WGS84_B_KM ** 2) / WGS84_B_KM ** 2
    aa = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    bb = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    d = bb * sin * (m + bb / 4 * (cos * (2 * m * m - 1) - bb / 6 * m * (4 * sin * sin - 3) * (4 * m * m - 3)))
    return np.where(np.abs(x - was) <= CONVERGED, WGS84_B_KM * aa * (angle - d), np.nan)


def _make_udf():
    @F.pandas_udf("double")
    def geodesic_km_udf(lat1: pd.Series, lon1: pd.Series,
                        lat2: pd.Series, lon2: pd.Series) -> pd.Series:
        out = geodesic_km_numpy(lat1.to_numpy(dtype="float64", na_value=math.nan),
                                lon1.to_numpy(dtype="float64", na_value=math.nan),
                                lat2.to_numpy(dtype="float64", na_value=math.nan),
                                lon2.to_numpy(dtype="float64", na_value=math.nan))
        return pd.Series(out).astype("Float64").mask(np.isnan(out))

    return geodesic_km_udf


_UDF = None


def geodesic_km_udf(lat1: Column | str, lon1: Column | str,
                    lat2: Column | str, lon2: Column | str) -> Column:
    global _UDF
    if _UDF is None:
        _UDF = _make_udf()
    return _UDF(_c(lat1), _c(lon1), _c(lat2), _c(lon2))
