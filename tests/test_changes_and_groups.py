"""Differences of versions, grouping sets and exact percentiles against brute force."""

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from blotter.operators import (apply_bag_difference, apply_keyed_difference, bag_difference, cube, exact_percentiles,
                               grouping_sets, keyed_difference, rollup)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def versions(spark, seed):
    r = random.Random(seed)
    row = lambda i: (i, r.choice(["x", "y", None]), r.choice([1, None]))
    old = [row(i) for i in range(200)] + [(7, "x", 1)] * 40 + [(None, "n", 1), (None, "m", 1), (300, "once", 1)]
    new = [x for x in old if r.random() < .8] + [row(i) for i in range(150, 260)] + [(7, "x", 1)] * 10 + [(300, "changed", None)]
    new = [x for x in new if x != (300, "once", 1)]
    schema = "id int, a string, b int"
    return old, new, spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)


@pytest.mark.parametrize("seed", [1, 2])
def test_applying_a_difference_gives_the_new_version(spark, seed):
    old, new, a, b = versions(spark, seed)
    diff = bag_difference(a, b)
    change = Counter(new)
    change.subtract(Counter(old))
    assert rows(diff) == Counter({(*k, n): 1 for k, n in change.items() if n})
    assert rows(apply_bag_difference(a, diff)) == Counter(new)
    keyed = keyed_difference(a, b, ["id"])
    assert rows(apply_keyed_difference(a, keyed, ["id"])) == Counter(new)
    assert ("update", 300, "changed", None) in rows(keyed)
    kinds = {r["action"] for r in keyed.collect()}
    assert kinds == {"insert", "delete", "update"}


def test_difference_of_equal_empty_and_reordered_versions(spark):
    _, _, a, b = versions(spark, 3)
    assert bag_difference(a, a.select("b", "id", "a")).count() == 0 and keyed_difference(a, a, ["id"]).count() == 0
    assert rows(apply_bag_difference(a.limit(0), bag_difference(a.limit(0), b))) == rows(b)
    assert apply_bag_difference(a, bag_difference(a, b.limit(0))).count() == 0
    with pytest.raises(ValueError):
        bag_difference(a, b.drop("a"))


def brute_sets(data, sets, n):
    out = Counter()
    for s in sets:
        groups = {}
        for r in data:
            k = tuple(r[i] if i in s else None for i in range(n))
            c, t = groups.get(k, (0, None))
            groups[k] = (c + 1, t if r[n] is None else (t or 0) + r[n])
        if not s and not groups:
            groups = {(None,) * n: (0, None)}
        bits = sum(1 << (n - 1 - i) for i in range(n) if i not in s)
        for k, (c, t) in groups.items():
            out[(*k, bits, c, t)] += 1
    return out


def test_rollup_cube_and_grouping_sets(spark):
    r = random.Random(1)
    data = [(r.choice([1, 1, 1, 2, None]), r.choice(["x", None]), r.choice([5, 6]), r.choice([10, None])) for _ in range(300)]
    for some in (data, data[:1], []):
        df = spark.createDataFrame(some, "a int, b string, c int, v int")
        assert rows(rollup(df, ["a", "b", "c"], ["v"])) == brute_sets(some, [(0, 1, 2), (0, 1), (0,), ()], 3)
        assert rows(cube(df, ["a", "b", "c"], ["v"])) == brute_sets(some, [s for n in range(4) for s in combinations(range(3), n)], 3)
        assert rows(grouping_sets(df, ["a", "b", "c"], [["c", "a"], ["b"], ["b"]], ["v"])) == brute_sets(some, [(0, 2), (1,)], 3)
    with pytest.raises(ValueError):
        grouping_sets(df, ["a"], [["z"]])


@pytest.mark.parametrize("bins", [16, 1024])
def test_percentiles_with_a_hot_group(spark, bins):
    r = random.Random(bins)
    draw = lambda: r.choice([r.gauss(0, 1), 10 ** r.uniform(-9, 9), -r.random(), 0.0, 5.0, None, float("nan")])
    data = [(r.choice([1] * 18 + [2, None]), draw()) for _ in range(600)] + [(3, 7.5)] + [(4, None)] + [(5, 1.0)] * 9 + [(6, x) for x in (float("inf"), -float("inf"), 1.0, 2.0)]
    shares = [0.0, 0.5, 0.95, 1.0]
    got = exact_percentiles(spark.createDataFrame(data, "k int, v double"), ["k"], "v", shares, bins)
    found = {(x["k"], x["share"]): (x["n"], x["percentile"]) for x in got.collect()}
    discrete = exact_percentiles(spark.createDataFrame(data, "k int, v double"), ["k"], "v", shares, bins, interpolate=False)
    disc = {(x["k"], x["share"]): x["percentile"] for x in discrete.collect()}
    groups = {}
    for k, v in data:
        if v is not None and v == v:
            groups.setdefault(k, []).append(v)
    assert set(found) == {(k, s) for k in groups for s in shares}
    for k, values in groups.items():
        values.sort()
        for s in shares:
            place = s * (len(values) - 1)
            lo, hi = values[int(place)], values[min(len(values) - 1, int(place) + (place > int(place)))]
            want = lo if lo == hi else lo + (hi - lo) * (place - int(place))
            n, p = found[k, s]
            assert disc[k, s] == values[max(math.ceil(s * len(values)) - 1, 0)]
            assert n == len(values) and (p == want or abs(p - want) <= 1e-12 * abs(want) or (p != p and want != want)), (k, s)


def test_percentiles_without_rows(spark):
    df = spark.createDataFrame([(1, None)], "k int, v double")
    assert exact_percentiles(df, ["k"], "v", [0.5]).count() == 0
    assert exact_percentiles(df.withColumn("v", F.lit(1.0)), ["k"], "v", []).count() == 0
