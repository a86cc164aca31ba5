"""Edge rows for the column helpers (FIXTURES.md section 4)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.functions import (daypart_number, daypart_text, descent_label, geodesic_km_udf,
                               parse_money, parse_timestamp, to_double, to_int,
                               with_geodesic_km)
from blotter.functions.geo import WGS84_A_KM, WGS84_F, geodesic_km_numpy


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_int_cast_is_tolerant(spark):
    assert one_col(spark, ["", "abc", "12.5", "90012-1234", " 7 ", "42", None], to_int) == \
        [None, None, None, None, 7, 42, None]


def test_double_cast_is_tolerant(spark):
    assert one_col(spark, ["33.737", "-118.7", "x", None, "0"], to_double) == \
        [33.737, -118.7, None, None, 0.0]


def test_timestamp_parse(spark):
    got = one_col(spark, ["03/15/2010 12:00:00 AM", "03/15/2010 01:30:05 PM", "2010-01-01", "bad", None],
                  parse_timestamp)
    assert got == [dt.datetime(2010, 3, 15, 0, 0), dt.datetime(2010, 3, 15, 13, 30, 5), None, None, None]


def test_money_parse(spark):
    assert one_col(spark, ["$41,234", "$1,234,567", "$-995", "n/a", None], parse_money) == \
        [41234.0, 1234567.0, -995.0, None, None]


def test_daypart_text_vs_number(spark):
    values = ["930", "0930", "2360", "1160", None, "0000", "0459", "0500", "1200", "1659", "1700",
              "2059", "2100", "2359"]
    text = one_col(spark, values, daypart_text)
    number = one_col(spark, values, daypart_number)
    assert text[:5] == ["NIGHT", "MORNING", "NIGHT", "OTHERWISE", "OTHERWISE"]
    assert number[:5] == ["MORNING", "MORNING", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert text[5:] == number[5:] == ["NIGHT", "NIGHT", "MORNING", "AFTERNOON", "AFTERNOON",
                                      "EVENING", "EVENING", "NIGHT", "NIGHT"]


def test_descent_label(spark):
    assert one_col(spark, ["H", "I", "W", "Q", None], descent_label) == \
        ["Hispanic/Latin/Mexican", "Hispanic/Latin/Mexican", "White", "OTHERWISE", "OTHERWISE"]


def vincenty_km(lat1, lon1, lat2, lon2):
    """Iterative inverse solution on the ellipsoid (brute-force check)."""
    a, f = WGS84_A_KM, WGS84_F
    b = (1 - f) * a
    L = math.radians(lon2 - lon1)
    U1 = math.atan((1 - f) * math.tan(math.radians(lat1)))
    U2 = math.atan((1 - f) * math.tan(math.radians(lat2)))
    sinU1, cosU1, sinU2, cosU2 = math.sin(U1), math.cos(U1), math.sin(U2), math.cos(U2)
    lam = L
    for _ in range(200):
        sl, cl = math.sin(lam), math.cos(lam)
        sin_sigma = math.hypot(cosU2 * sl, cosU1 * sinU2 - sinU1 * cosU2 * cl)
        if sin_sigma == 0:
            return 0.0
        cos_sigma = sinU1 * sinU2 + cosU1 * cosU2 * cl
        sigma = math.atan2(sin_sigma, cos_sigma)
        sin_alpha = cosU1 * cosU2 * sl / sin_sigma
        cos2a = 1 - sin_alpha ** 2
        cos2sm = cos_sigma - 2 * sinU1 * sinU2 / cos2a if cos2a else 0.0
        C = f / 16 * cos2a * (4 + f * (4 - 3 * cos2a))
        prev = lam
        lam = L + (1 - C) * f * sin_alpha * (
            sigma + C * sin_sigma * (cos2sm + C * cos_sigma * (-1 + 2 * cos2sm ** 2)))
        if abs(lam - prev) < 1e-13:
            break
    u2 = cos2a * (a * a - b * b) / (b * b)
    A = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
    B = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
    ds = B * sin_sigma * (cos2sm + B / 4 * (cos_sigma * (-1 + 2 * cos2sm ** 2)
                          - B / 6 * cos2sm * (-3 + 4 * sin_sigma ** 2) * (-3 + 4 * cos2sm ** 2)))
    return b * A * (sigma - ds)


def native_km(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    return [r[0] for r in with_geodesic_km(df, "a", "b", "c", "d", "x").select("x").collect()]


def test_geodesic_is_within_a_millimetre_of_an_iterative_solution(spark):
    rng = np.random.default_rng(7)
    pts = [(float(33.7 + rng.random() * 0.6), float(-118.7 + rng.random() * 0.6),
            float(33.7 + rng.random() * 0.6), float(-118.7 + rng.random() * 0.6)) for _ in range(9_000)]
    pts += [(0.0, 0.0, float(33.7 + rng.random() * 0.6), float(-118.7 + rng.random() * 0.6)) for _ in range(900)]
    pts += [(float(rng.uniform(-80, 80)), float(rng.uniform(-60, 60)), float(rng.uniform(-80, 80)), float(rng.uniform(-60, 60)))
            for _ in range(98)]
    pts += [(34.0, -118.2, 34.0, -118.2), (34.05, -118.25, 40.71, -74.0)]
    got = native_km(spark, pts)
    assert max(abs(g - vincenty_km(*p)) for p, g in zip(pts, got)) < 1e-6
    assert got[-2] == 0.0


def test_geodesic_pinned_distances(spark):
    # Published or closed-form: JFK to LHR, a degree and a half turn's worth of the equator, a meridian quadrant.
    got = native_km(spark, [(40.6, -73.8, 51.6, -0.5), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 90.0, 0.0), (0.0, 10.0, 0.0, 100.0)])
    want = [5551.759400, 6378.137 * math.pi / 180, 10001.965729, 6378.137 * math.pi / 2]
    assert got == pytest.approx(want, abs=1e-6)


def test_geodesic_nulls_antipodes_and_udf_agree(spark):
    pts = [(34.0, -118.2, 34.1, -118.3), (None, -118.2, 34.1, -118.3), (34.0, -118.2, 34.0, -118.2), (0.0, 0.0, 0.5, 179.7)]
    native = native_km(spark, pts)
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    udf = [r[0] for r in df.select(geodesic_km_udf("a", "b", "c", "d")).collect()]
    assert native[1] is None and udf[1] is None and native[3] is None and udf[3] is None     # no wrong number
    assert native[2] == 0.0 and udf[2] == 0.0
    assert native[0] == pytest.approx(udf[0], rel=1e-12)
    assert float(geodesic_km_numpy(np.array([34.0]), np.array([-118.2]), np.array([34.1]),
                                   np.array([-118.3]))[0]) == pytest.approx(native[0], rel=1e-12)
    assert with_geodesic_km(df, "a", "b", "c", "d", "x").columns == ["a", "b", "c", "d", "x"]


def test_every_descent_label(spark):
    want = {"A": "Other Asian", "B": "Black", "C": "Chinese", "D": "Cambodian", "F": "Filipino", "G": "Guamanian",
            "H": "Hispanic/Latin/Mexican", "I": "Hispanic/Latin/Mexican", "J": "Japanese", "K": "Korean", "L": "Laotian",
            "O": "Other", "P": "Pacific Islander", "S": "Samoan", "U": "Hawaiian", "V": "Vietnamese", "W": "White",
            "X": "Unknown", "Z": "Asian Indian", "E": "OTHERWISE", "": "OTHERWISE", None: "OTHERWISE"}
    assert one_col(spark, list(want), descent_label) == list(want.values())


def test_timestamp_parse_ignores_session_time_zone(spark):
    """A wall time inside a daylight-saving gap of the session zone is kept as written."""
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")   # DST began at midnight
    try:
        got = one_col(spark, ["10/15/1995 12:00:00 AM", "bad", "02/30/2010 12:00:00 AM"], parse_timestamp)
    finally:
        spark.conf.unset("spark.sql.session.timeZone")
    assert got == [dt.datetime(1995, 10, 15, 0, 0), None, None]
