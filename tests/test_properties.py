"""Property tests: operators against brute force in plain Python on random inputs.

Each example builds one small DataFrame, so a few dozen examples per
property keep the suite quick while covering nulls, ties, hot keys and
duplicate coordinates.
"""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.functions import daypart_number, daypart_text, descent_label
from blotter.functions.descent import DESCENT_LABELS
from blotter.operators import bottom_k, salted_join, top_k, top_n_per_group, union_distinct
from blotter.plans import q3

SETTINGS = settings(max_examples=20, deadline=None, derandomize=True,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])

hhmm = st.one_of(st.none(), st.from_regex(r"[0-9]{1,4}", fullmatch=True), st.sampled_from(["", "ab", "12:30"]))


def model_text(t):
    if t is None:
        return "OTHERWISE"
    if "0500" <= t <= "1159":
        return "MORNING"
    if "1200" <= t <= "1659":
        return "AFTERNOON"
    if "1700" <= t <= "2059":
        return "EVENING"
    if t >= "2100" or t <= "0459":
        return "NIGHT"
    return "OTHERWISE"


def model_number(t):
    try:
        n = int(t.strip()) if t is not None and t.strip().isdigit() else None
    except ValueError:
        n = None
    if n is None:
        return "UNKNOWN"
    if 500 <= n <= 1159:
        return "MORNING"
    if 1200 <= n <= 1659:
        return "AFTERNOON"
    if 1700 <= n <= 2059:
        return "EVENING"
    if 2100 <= n <= 2359 or 0 <= n <= 459:
        return "NIGHT"
    return "UNKNOWN"


@SETTINGS
@given(st.lists(hhmm, min_size=1, max_size=40))
def test_dayparts_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = df.select(daypart_text("t").alias("a"), daypart_number("t").alias("b")).collect()
    assert [r["a"] for r in got] == [model_text(v) for v in values]
    assert [r["b"] for r in got] == [model_number(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(sorted(DESCENT_LABELS) + ["Q", "h", ""])), max_size=30))
def test_descent_label_matches_table(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    got = [r[0] for r in df.select(descent_label("c")).collect()]
    assert got == [DESCENT_LABELS.get(c, "OTHERWISE") if c is not None else "OTHERWISE" for c in codes]


rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3)), max_size=30)


@SETTINGS
@given(rows, rows)
def test_union_distinct_is_set_union(spark, a, b):
    da = spark.createDataFrame(a, "k string, v int")
    db = spark.createDataFrame(b, "k string, v int")
    got = Counter(tuple(r) for r in union_distinct(da, db).collect())
    assert got == Counter(set(a) | set(b))


measures = st.lists(st.tuples(st.integers(0, 50), st.one_of(st.none(), st.integers(-5, 5))),
                    max_size=25, unique_by=lambda r: r[0])


@SETTINGS
@given(measures, st.integers(1, 5))
def test_top_and_bottom_k_match_sorting(spark, data, k):
    df = spark.createDataFrame(data, "id int, m int")
    known = [r for r in data if r[1] is not None]
    top = [tuple(r) for r in top_k(df, "m", k, ["id"]).collect()]
    bottom = [tuple(r) for r in bottom_k(df, "m", k, ["id"]).collect()]
    assert top == sorted(known, key=lambda r: (-r[1], r[0]))[:k]
    assert bottom == sorted(known, key=lambda r: (r[1], r[0]))[:k]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from([2000, 2001, None]), st.integers(1, 12), st.integers(0, 4)),
                max_size=30, unique_by=lambda r: (r[0], r[1])), st.integers(1, 3))
def test_rank_filter_matches_sql_rank(spark, data, n):
    df = spark.createDataFrame(data, "year int, month int, count int")
    got = Counter(tuple(r) for r in top_n_per_group(df, ["year"], [F.col("count").desc()], n).collect())
    want = Counter()
    for y in {r[0] for r in data}:
        grp = [r for r in data if r[0] == y]
        for r in grp:
            rank = 1 + sum(1 for o in grp if o[2] > r[2])
            if rank <= n:
                want[(r[0], r[1], r[2], rank)] += 1
    assert got == want


@SETTINGS
@given(st.lists(st.integers(0, 4), max_size=60), st.integers(1, 6))
def test_salted_join_equals_plain_join(spark, keys, salts):
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, v int")
    small = spark.createDataFrame([(0, "x"), (1, "y"), (1, "y2"), (3, "z")], "sk int, name string")
    plain = Counter(tuple(r) for r in big.join(small, big["k"] == small["sk"]).select("v", "name").collect())
    salted = Counter(tuple(r) for r in salted_join(big, small, "k", "sk", rows_per_salt=salts).select("v", "name").collect())
    assert plain == salted


points = st.tuples(st.sampled_from([34.0, 34.1, 34.2]), st.sampled_from([-118.0, -118.1]))


@SETTINGS
@given(st.lists(st.tuples(points, st.sampled_from(["H", "I", "W", None])), max_size=40),
       st.lists(st.tuples(points, st.integers(1, 4)), max_size=10),
       st.sampled_from(["auto", "broadcast", "merge", "shuffle_hash"]),
       st.sampled_from([1_000_000, 0]))             # 0: the broadcast bound is exceeded
def test_victims_per_zip_matches_brute_force(spark, incidents, geo, strategy, bound):
    inc = spark.createDataFrame([(p[0], p[1], d) for p, d in incidents], "lat double, lon double, vict_descent string")
    g = spark.createDataFrame([(p[0], p[1], z) for p, z in geo], "lat double, lon double, zip int")
    zips = spark.createDataFrame([(1,), (2,), (3,)], "zip int")
    got = Counter({(r["zip"], r["vict_descent"]): r["count"]
                   for r in q3.victims_per_zip(inc, g, zips, strategy, bound).collect()})
    want = Counter()
    for p, d in incidents:                       # nested loops: every incident x every geocoding row
        if d is None:
            continue
        for gp, z in geo:
            if gp == p and z in (1, 2, 3):
                want[(z, d)] += 1
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "c"]), st.integers(0, 9)), max_size=30))
def test_one_per_key_keeps_the_largest_row(spark, data):
    from blotter.operators import one_per_key
    df = spark.createDataFrame(data, "k int, name string, y int")
    got = {r["k"]: (r["name"], r["y"]) for r in one_per_key(df, "k").collect()}
    want = {}
    for k, name, y in data:
        want[k] = max(want.get(k, (name, y)), (name, y))
    assert got == want


coords = st.tuples(st.floats(33.0, 35.0), st.floats(-119.0, -117.0))


@SETTINGS
@given(st.lists(st.tuples(coords, coords), min_size=1, max_size=30))
def test_distance_is_symmetric_and_non_negative(spark, pairs):
    from blotter.functions import with_geodesic_km
    df = spark.createDataFrame([(a[0], a[1], b[0], b[1]) for a, b in pairs], "a double, b double, c double, d double")
    got = with_geodesic_km(with_geodesic_km(df, "a", "b", "c", "d", "ab"), "c", "d", "a", "b", "ba").collect()
    for r in got:
        assert r["ab"] >= 0 and abs(r["ab"] - r["ba"]) <= 1e-9 * max(1.0, r["ab"])
