"""Nearest-site, interval, as-of joins and islands against brute force, with skew."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict

import pytest

from blotter.operators import asof_join, interval_join, islands, k_nearest, overlap_join
from blotter.operators.nearest import EARTH_KM

DAY = dt.datetime(2020, 3, 1)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def refused(df):
    p = plan(df)
    return "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p or "EvalPython" in p


# --- nearest ------------------------------------------------------------

def km(a, b):
    (p, q), (r, s) = [(math.radians(x), math.radians(y)) for x, y in (a, b)]
    h = math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2
    return round(2 * EARTH_KM * math.asin(min(1, math.sqrt(h))), 6)


def brute_nearest(points, sites, k):
    out = Counter()
    ok = lambda x: x is not None and not math.isnan(x)
    sites = {(key, la, lo) for key, la, lo in sites if ok(la) and ok(lo) and abs(la) <= 90}
    for i, la, lo in points:
        if ok(la) and ok(lo) and abs(la) <= 90:
            near = sorted((km((la, lo), (a, o)), key) for key, a, o in sites)[:k]
            for n, (d, key) in enumerate(near):
                out[i, key, round(d, 4), n + 1] += 1
    return out


def check_nearest(spark, points, sites, k, **kw):
    p = spark.createDataFrame(points, "id int, lat double, lon double")
    s = spark.createDataFrame(sites, "prec int, y double, x double")
    out = k_nearest(p, s, k, "prec", site_lat="y", site_lon="x", **kw)
    assert not refused(out)
    got = Counter((r["id"], r["near_key"], round(r["near_km"], 4), r["near_rank"]) for r in out.collect())
    assert got == brute_nearest(points, sites, k)


@pytest.mark.parametrize("k", [1, 4])
def test_nearest_over_the_globe(spark, k):
    r = random.Random(k)
    spot = lambda: (math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180))
    town = lambda: (34 + r.gauss(0, .05), -118 + r.gauss(0, .05))
    sites = [(i, *(town() if i % 3 else spot())) for i in range(150)]
    points = [(i, *(town() if i % 2 else spot())) for i in range(150)]
    points += [(900, 90.0, 0.0), (901, -90.0, 50.0), (902, 0.0, 180.0), (903, 0.0, -180.0), (904, 10.0, 179.9999), (905, 10.0, -179.9999)]
    check_nearest(spark, points, sites, k, crowd=4)


def test_nearest_over_the_180th_meridian_and_ties(spark):
    sites = [(1, 0.0, 179.0), (2, 0.0, -178.0), (3, 1.0, 0.0), (4, -1.0, 0.0), (5, 1.0, 0.0), (6, 1.0, 0.0), (7, 1.0, 0.0)]
    points = [(1, 0.0, -179.9), (2, 0.0, 179.9), (3, 0.0, 0.0), (3, 0.0, 0.0), (4, 1.0, 0.0), (5, None, 1.0), (6, float("nan"), 1.0), (7, 91.0, 0.0)]
    for k in (1, 2, 3, 9):
        check_nearest(spark, points, [*sites, (None, 0.0, 0.0)][:7] + [(8, None, 0.0), (9, float("nan"), 2.0)], k)


def test_nearest_with_a_hot_spot_and_a_crowd(spark):
    r = random.Random(7)
    sites = [(i, 34.0, -118.0) for i in range(200)] + [(1000 + i, 34 + r.uniform(0, 1e-4), -118 + r.uniform(0, 1e-4)) for i in range(300)] + [(5000, -30.0, 20.0)]
    points = [(i, 34.0, -118.0) for i in range(400)] + [(i, 36 + r.uniform(0, 5), -118.0) for i in range(50)] + [(999, -30.0, 20.0)]
    check_nearest(spark, points, sites, 3, crowd=8, rows_per_salt=50, chunk=16)


def test_nearest_without_sites_or_points(spark):
    check_nearest(spark, [(1, 0.0, 0.0)], [], 2)
    check_nearest(spark, [], [(1, 0.0, 0.0)], 2)
    p = spark.createDataFrame([(1, 0.0, 0.0)], "near_km int, lat double, lon double")
    with pytest.raises(ValueError):
        k_nearest(p, p, 1, "lat")


def test_nearest_cells_settle_where_their_sites_are(spark, monkeypatch):
    # The sphere cuts many cells near a corner: as whole cells they would be merged up to the whole globe.
    from blotter.operators import nearest

    levels = []
    settle = nearest._settle

    def seen(*args):
        out = settle(*args)
        levels.append([level for level, _, _ in out])
        return out

    monkeypatch.setattr(nearest, "_settle", seen)
    at = [(i, 33 + i % 60 * .01, -117 - i // 60 * .01) for i in range(3600)]
    p = spark.createDataFrame([(i, la + .001, lo + .001) for i, la, lo in at], "id int, lat double, lon double")
    s = spark.createDataFrame(at, "prec int, y double, x double")
    out = k_nearest(p, s, 1, "prec", site_lat="y", site_lon="x")
    assert out.filter("id <> near_key").count() == 0 and out.count() == 3600
    assert len(levels[0]) <= 3


def test_nearest_among_many_sites_of_one_key(spark, monkeypatch):
    # Arrays of candidates are dealt by more than the key.
    from blotter.operators import nearest

    longest = []
    collected = nearest.F.collect_list
    monkeypatch.setattr(nearest.F, "collect_list", lambda c: longest.append(1) or nearest.F.when(nearest.F.count(nearest.F.lit(1)) <= 64, collected(c)))
    r = random.Random(9)
    sites = [(1, 34 + r.uniform(0, 1e-6), -118 + r.uniform(0, 1e-6)) for _ in range(600)]
    check_nearest(spark, [(1, 34.0, -118.0), (2, 34.1, -118.0)], sites, 1, chunk=16)
    assert longest


# --- intervals ----------------------------------------------------------

def moment(r, days=20):
    return None if r.random() < 0.03 else DAY + dt.timedelta(seconds=r.randrange(days * 86400))


def spans(r, n, longest):
    out = []
    for i in range(n):
        a = moment(r)
        b = a and a + dt.timedelta(seconds=int(longest ** r.random()) - 2)
        out.append((i, r.choice([1, 1, 1, 2, None]), a, b))
    return out


def test_points_in_intervals(spark):
    r = random.Random(1)
    points = [(i, r.choice([1, 1, 1, 2, None]), moment(r)) for i in range(500)] + [(7, 1, DAY)] * 2
    periods = spans(r, 300, 86400 * 30) + [(900, 1, DAY, DAY + dt.timedelta(days=400)), (901, 1, DAY, DAY), (902, 1, DAY, DAY + dt.timedelta(seconds=1))]
    p = spark.createDataFrame(points, "id int, area int, t timestamp_ntz")
    s = spark.createDataFrame(periods, "period int, area int, a timestamp_ntz, b timestamp_ntz")
    want = Counter((i, area, k) for i, area, t in points for k, ar, a, b in periods if area == ar is not None and t and a and a <= t < b)
    for salt in (1_000_000, 20):
        got = interval_join(p, s, "t", "a", "b", ["area"], rows_per_salt=salt)
        assert not refused(got)
        assert rows(got.select("id", "area", "period")) == want
    want = Counter((i, k) for i, _, t in points for k, _, a, b in periods if t and a and a <= t < b)
    assert rows(interval_join(p.drop("area"), s.drop("area"), "t", "a", "b", width=60).select("id", "period")) == want


def test_intervals_of_numbers_and_no_rows(spark):
    p = spark.createDataFrame([(1, 0.5), (2, -3.0), (3, 1e6)], "id int, t double")
    s = spark.createDataFrame([(1, -3.0, 0.6), (2, 0.5, 0.5), (3, -1e7, 1e7)], "period int, a double, b double")
    assert rows(interval_join(p, s, "t", "a", "b", width=1).select("id", "period")) == Counter({(1, 1): 1, (2, 1): 1, (1, 3): 1, (2, 3): 1, (3, 3): 1})
    assert interval_join(p, s.limit(0), "t", "a", "b").count() == 0 and interval_join(p.limit(0), s, "t", "a", "b").count() == 0
    with pytest.raises(ValueError):
        interval_join(p, s.withColumn("t", s["a"]), "t", "a", "b")


def test_overlapping_intervals(spark):
    r = random.Random(2)
    left, right = spans(r, 200, 86400 * 10), spans(r, 200, 86400 * 3)
    left += [(1000, 1, DAY, DAY + dt.timedelta(hours=1))] * 2
    right += [(1000, 1, DAY, DAY + dt.timedelta(hours=1)), (1001, 1, DAY + dt.timedelta(hours=1), DAY + dt.timedelta(hours=2))]
    a = spark.createDataFrame(left, "l int, area int, ls timestamp, le timestamp")
    b = spark.createDataFrame(right, "r int, area int, rs timestamp, re timestamp")
    want = Counter((i, j) for i, x, s, e in left for j, y, t, f in right if x == y is not None and s and t and s < e and t < f and s < f and t < e)
    assert rows(overlap_join(a, b, "ls", "le", "rs", "re", ["area"]).select("l", "r")) == want


def test_the_interval_query_parses_each_time_once(spark, tmp_path):
    from blotter.plans.extended import join_interval

    ntz = "timestamp_ntz'1996-01-02 00:00:00'"
    spark.sql(f"SELECT id AS o_orderkey, id AS o_custkey, {ntz} AS o_orderdate, 'x' AS o_orderpriority FROM range(1, 20)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(f"SELECT id AS l_orderkey, 1 AS l_linenumber, id AS l_suppkey, 36 AS l_partkey, 5.0D AS l_quantity, {ntz} AS l_shipdate FROM range(1, 20)").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = join_interval(spark, str(tmp_path))
    assert "gettimestamp" not in plan(out).lower()
    assert rows(out) == Counter({(i, i % 27 + 1, i * 10 + 1): 1 for i in range(1, 20)})


def shuffled(df):
    """The rows that each shuffle by salt wrote, once ``df`` has run."""
    df.collect()
    out, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        n = nodes.pop()
        kind = n.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(n.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(n.plan())
        else:
            if kind == "ShuffleExchangeExec" and any(c in n.outputPartitioning().toString() for c in ("_salt#", "_copy#")):
                out.append(n.metrics().apply("shuffleRecordsWritten").value())
            nodes += [n.children().apply(i) for i in range(n.children().size())]
    return out


def test_few_copies_of_intervals_are_shuffled(spark):
    # Copies in bins take disk: an interval has two at most, whatever its length.
    hours = lambda n: DAY + dt.timedelta(hours=n)
    for long in (3, 10, 40, 200):
        p = spark.createDataFrame([(i, 1, hours(i * 5)) for i in range(300)], "id int, area int, t timestamp_ntz")
        s = spark.createDataFrame([(i, 1, hours(i * 5 + 1), hours(i * 5 + 1 + long)) for i in range(300)], "period int, area int, a timestamp_ntz, b timestamp_ntz")
        points, periods = sorted(shuffled(interval_join(p, s, "t", "a", "b", ["area"])))
        assert points == 300 and periods <= 600


def test_each_side_of_an_overlap_is_shuffled_once(spark):
    hours = lambda n: DAY + dt.timedelta(hours=n)
    a = spark.createDataFrame([(i, hours(i * 5), hours(i * 5 + 3)) for i in range(300)], "l int, ls timestamp, le timestamp")
    b = spark.createDataFrame([(i, hours(i * 5 + 1), hours(i * 5 + 26)) for i in range(300)], "r int, rs timestamp, re timestamp")
    sides = shuffled(overlap_join(a, b, "ls", "le", "rs", "re"))
    assert len(sides) == 2 and sum(sides) <= 300 * 4 + 300 * 2


@pytest.mark.parametrize("salt", [1_000_000, 20])
def test_overlaps_of_short_and_long(spark, salt):
    # Every bin and salt gives a pair at most once, whichever side is longer or starts first.
    r = random.Random(11)
    some = lambda n: [(i, r.choice([1, 1, 1, 2, None]), s := r.uniform(-500, 500), s + 4 ** r.uniform(-2, 6) * r.choice([1, 1, 1, -1])) for i in range(n)]
    left, right = some(250), some(250)
    left += [(900, 1, -64.0, 0.0), (901, 1, 0.0, 64.0), (902, 1, 5.0, 5.0), (903, 1, None, 5.0)] * 2
    right += [(900, 1, -64.0, 0.0), (901, 1, 0.0, 64.0), (902, 1, 5.0, 5.0), (903, 1, 5.0, None)] * 2
    a = spark.createDataFrame(left, "l int, area int, ls double, le double")
    b = spark.createDataFrame(right, "r int, area int, rs double, re double")
    want = Counter((i, x, j) for i, x, s, e in left for j, y, t, f in right if x == y is not None and None not in (s, t, e, f) and s < e and t < f and s < f and t < e)
    got = overlap_join(a, b, "ls", "le", "rs", "re", ["area"], width=1, rows_per_salt=salt)
    assert got.columns == ["l", "area", "ls", "le", "r", "rs", "re"] and not refused(got)
    assert rows(got.select("l", "area", "r")) == want
    assert overlap_join(a.limit(0), b, "ls", "le", "rs", "re", ["area"]).count() == 0 == overlap_join(a, b.limit(0), "ls", "le", "rs", "re", ["area"]).count()


def test_exploded_intervals_are_not_broadcast(spark, tmp_path):
    # Spark sizes written rows without the copies that explode adds.
    s = spark.createDataFrame([(i, DAY, DAY + dt.timedelta(hours=i % 9)) for i in range(60)], "period int, a timestamp_ntz, b timestamp_ntz")
    s.write.parquet(f"{tmp_path}/s")
    s = spark.read.parquet(f"{tmp_path}/s")
    for out in (interval_join(s.select("period", "a"), s.toDF("other", "c", "d"), "a", "c", "d"), overlap_join(s, s.toDF("other", "c", "d"), "a", "b", "c", "d")):
        assert "SortMergeJoin" in plan(out)


# --- as-of --------------------------------------------------------------

@pytest.mark.parametrize("same_time,max_age", [(True, None), (False, None), (True, 3 * 86400)])
def test_asof_with_a_hot_key(spark, same_time, max_age):
    r = random.Random(3)
    area = lambda: r.choice([1] * 18 + [2, None])
    left = [(i, area(), moment(r)) for i in range(400)] + [(5, 1, DAY + dt.timedelta(days=3))] * 90
    right = [(area(), moment(r), i, r.choice(["x", "y", None])) for i in range(300)] + [(1, DAY + dt.timedelta(days=3), i, "z") for i in range(60)]
    p = spark.createDataFrame(left, "id int, area int, t timestamp_ntz")
    s = spark.createDataFrame(right, "area int, seen timestamp_ntz, reading int, what string")
    want = Counter()
    for i, a, t in left:
        fit = [(u, n, w) for b, u, n, w in right if t and u and a == b is not None and (u <= t if same_time else u < t)]
        best = max(fit, key=lambda x: x[:2], default=(None, None, None))
        if max_age and best[0] and (t - best[0]).total_seconds() > max_age:
            best = (None, None, None)
        want[i, a, t, *best] += 1
    got = asof_join(p, s, ["area"], "t", "seen", ["reading"], same_time=same_time, max_age=max_age, rows_per_salt=30)
    assert not refused(got)
    assert rows(got) == want


def test_asof_without_rows(spark):
    p = spark.createDataFrame([(1, 1, DAY)], "id int, area int, t timestamp_ntz")
    s = spark.createDataFrame([], "area int, seen timestamp_ntz, reading int")
    assert rows(asof_join(p, s, ["area"], "t", "seen", ["reading"])) == Counter({(1, 1, DAY, None, None): 1})
    assert asof_join(p.limit(0), s, ["area"], "t", "seen", ["reading"]).count() == 0


# --- islands ------------------------------------------------------------

@pytest.mark.parametrize("bucket", [3600, 86400, 30 * 86400])
def test_islands_with_nine_tenths_in_one_area(spark, bucket):
    r = random.Random(4)
    data = [(i, r.choice([1] * 18 + [2, None]), moment(r, 200)) for i in range(1500)] + [(9, 1, DAY)] * 50
    gap = 4 * 3600
    want = Counter()
    by = defaultdict(list)
    for _, a, t in data:
        if a is not None and t:
            by[a].append(t)
    for a, times in by.items():
        times.sort()
        runs = [[times[0]]]
        for t in times[1:]:
            if (t - runs[-1][-1]).total_seconds() > gap:
                runs.append([])
            runs[-1].append(t)
        for n, run in enumerate(runs, 1):
            want[a, n, run[0], run[-1], len(run)] += 1
    df = spark.createDataFrame(data, "id int, area int, t timestamp_ntz")
    assert rows(islands(df, ["area"], "t", gap, bucket)) == want
    assert islands(df.limit(0), ["area"], "t", gap).count() == 0


def test_islands_read_each_time_once(spark):
    # A costly time is computed once a row, not again in every filter and bucket made of it.
    read = spark.sparkContext.accumulator(0)

    def text(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(i % 3, DAY + dt.timedelta(hours=i)) for i in range(90)], "area int, t timestamp_ntz").mapInArrow(text, "area int, t timestamp_ntz")
    assert sum(r["n"] for r in islands(df, ["area"], "t", 86400).collect()) == 90
    assert read.value == 90
