"""Operator semantics on micro-fixtures (FIXTURES.md section 4) and plan shape."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter.operators import (bottom_k, checked_broadcast, firearm_with_coordinates, group_count,
                               join_with_strategy, null_safe_condition, null_safe_join, one_per_key,
                               salted_join, top_k, top_n_per_group, union_all, union_distinct)
from blotter.plans import q3, q4


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_union_keeps_or_drops_cross_file_duplicates(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, v string")
    b = spark.createDataFrame([("2", "y"), ("3", "z"), ("3", "z")], "k string, v string")
    assert union_all(a, b).count() == 5
    assert rows(union_distinct(a, b)) == Counter({("1", "x"): 1, ("2", "y"): 1, ("3", "z"): 1})


def test_union_by_name_aligns_reordered_columns(spark):
    a = spark.createDataFrame([("1", "x")], "k string, v string")
    b = spark.createDataFrame([("y", "2")], "v string, k string")
    assert rows(union_all(a, b)) == Counter({("1", "x"): 1, ("2", "y"): 1})
    assert rows(union_all(a, b, by_name=False)) == Counter({("1", "x"): 1, ("y", "2"): 1})


def test_null_keys_match_only_null_safe(spark):
    left = spark.createDataFrame([(None, 1)], "k int, v int")
    right = spark.createDataFrame([(None, "x")], "k int, w string")
    assert left.join(right, left["k"] == right["k"]).count() == 0
    assert left.join(right, null_safe_condition(left, right, [("k", "k")])).count() == 1


def test_one_per_key_is_deterministic(spark):
    st = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], "prec int, d string, y double")
    got = {r["prec"]: r["d"] for r in one_per_key(st, "prec").collect()}
    assert got == {1: "b", 2: "c"}
    # a plain join fans out on the duplicate key
    inc = spark.createDataFrame([(1,)], "prec int")
    assert inc.join(st, "prec").count() == 2


def test_codes_sharing_a_label(spark):
    inc = spark.createDataFrame([(90001, "H"), (90001, "H"), (90001, "I")], "zip int, vict_descent string")
    by_code = group_count(inc, "zip", "vict_descent")
    assert by_code.count() == 2
    from blotter.functions import descent_label
    by_label = group_count(inc.select("zip", descent_label("vict_descent").alias("d")), "zip", "d")
    assert [tuple(r) for r in by_label.collect()] == [(90001, "Hispanic/Latin/Mexican", 3)]


def test_null_income_never_poorest(spark):
    inc = spark.createDataFrame([(1, None), (2, 10.0), (3, 20.0), (4, 30.0), (5, 40.0)],
                                "zip int, median_income double")
    assert [r["zip"] for r in bottom_k(inc, "median_income", 3, ["zip"]).collect()] == [2, 3, 4]
    assert [r["zip"] for r in top_k(inc, "median_income", 3, ["zip"]).collect()] == [5, 4, 3]


def test_top_k_plans_as_take_ordered(spark):
    df = spark.range(1000).withColumn("m", F.col("id") % 7)
    assert "TakeOrderedAndProject" in plan(top_k(df, "m", 3, ["id"]))


def test_rank_ties_keep_extra_rows(spark):
    df = spark.createDataFrame([(2000, 1, 5), (2000, 2, 4), (2000, 3, 3), (2000, 4, 3), (2000, 5, 1)],
                               "year int, month int, count long")
    got = top_n_per_group(df, ["year"], [F.col("count").desc()], 3)
    assert sorted((r["month"], r["rank"]) for r in got.collect()) == [(1, 1), (2, 2), (3, 3), (4, 3)]
    assert "WindowGroupLimit" in plan(got)


def test_firearm_filter_drops_zero_and_null_positions(spark):
    df = spark.createDataFrame(
        [(1, 150, 34.0, -118.0), (2, 150, 0.0, 0.0), (3, 150, None, -118.0), (4, 99, 34.0, -118.0),
         (5, 200, 34.0, -118.0), (6, 100, 34.0, -118.0), (7, None, 34.0, -118.0)],
        "id int, weapon_cd int, lat double, lon double")
    assert sorted(r["id"] for r in firearm_with_coordinates(df).collect()) == [1, 6]


def test_empty_input_gives_empty_result(spark):
    inc = spark.createDataFrame([], "area int, weapon_cd int, lat double, lon double")
    st = spark.createDataFrame([(1, "A", 34.0, -118.0)], "prec int, division string, y double, x double")
    for strategy in ("auto", "broadcast", "salted", "merge"):
        assert q4.station_distance(inc, st, strategy).collect() == []


def test_checked_broadcast_is_bound_in_bytes(spark):
    df = spark.range(100).withColumn("t", F.lit("x" * 1000))
    assert checked_broadcast(df, 100_000) is None and checked_broadcast(df, 110_000) is not None
    assert checked_broadcast(df.limit(0), 0) is not None
    big = spark.range(10000).withColumnRenamed("id", "k")
    small = spark.range(50).withColumnRenamed("id", "k")
    # beyond the bound no broadcast is forced; the optimizer's own choice stands
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_with_strategy(big, small, ["k"], strategy="broadcast", max_bytes=10)
        assert joined.count() == 50
        assert "BroadcastExchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    joined = join_with_strategy(big, small, ["k"], strategy="broadcast", max_bytes=10_000)
    assert "BroadcastHashJoin" in plan(joined)


@pytest.mark.parametrize("strategy,node", [("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin")])
def test_strategy_hints_pick_the_node(spark, strategy, node):
    a = spark.range(1000).withColumnRenamed("id", "k")
    b = spark.range(10).withColumnRenamed("id", "k")
    j = join_with_strategy(a, b, ["k"], strategy=strategy)
    j.count()
    assert node in plan(j)


def test_unknown_strategy_is_rejected(spark):
    a = spark.range(3)
    with pytest.raises(ValueError):
        join_with_strategy(a, a, ["id"], strategy="shuffle_replicate_nl")


def test_salted_join_equals_plain_join_under_a_hot_key(spark):
    big = spark.range(3000).select((F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 5)).alias("k"),
                                   F.col("id").alias("v"))
    small = spark.createDataFrame([(i, f"s{i}") for i in range(5)], "sk long, name string")
    plain = big.join(small, big["k"] == small["sk"]).select("v", "name")
    salted = salted_join(big, small, "k", "sk", rows_per_salt=100).select("v", "name")
    assert rows(plain) == rows(salted)


def test_q3_strategies_agree_with_fanout(spark):
    inc = spark.createDataFrame(
        [(34.0, -118.0, "H"), (34.0, -118.0, "H"), (34.0, -118.0, "I"), (34.1, -118.1, "W"),
         (34.2, -118.2, None), (34.0, -118.0, "W")], "lat double, lon double, vict_descent string")
    # (34.0,-118.0) appears twice in the geocoding table (fan-out), once per ZIP
    geo = spark.createDataFrame([(34.0, -118.0, 1), (34.0, -118.0, 2), (34.1, -118.1, 1), (34.2, -118.2, 3)],
                                "lat double, lon double, zip int")
    income = spark.createDataFrame([(1, "Los Angeles (A)", 10.0), (2, "Los Angeles (B)", 20.0),
                                    (3, "Los Angeles (C)", 30.0), (4, "Elsewhere", 99.0)],
                                   "zip int, community string, median_income double")
    results = [rows(q3.descent_richest(inc, geo, income, s, k=2))
               for s in ("auto", "broadcast", "merge", "shuffle_hash")]
    assert all(r == results[0] for r in results)
    assert results[0] == Counter({(2, "H", "Hispanic/Latin/Mexican", 2): 1,
                                  (2, "I", "Hispanic/Latin/Mexican", 1): 1,
                                  (2, "W", "White", 1): 1})


def _hot_incidents(spark):
    """A third of the incidents share area and position."""
    rows = [(i, 7, 150, 34.0, -118.0) for i in range(600)] + \
           [(600 + i, 1 + i % 5, 150, 34.0 + i / 1000, -118.0) for i in range(1200)]
    inc = spark.createDataFrame(rows, "dr_no long, area int, weapon_cd int, lat double, lon double")
    st = spark.createDataFrame([(a, f"D{a}", 34.1, -118.1) for a in range(1, 200)],
                               "prec int, division string, y double, x double")
    return inc, st


def test_salted_route_spreads_a_hot_spot(spark):
    inc, st = _hot_incidents(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = q4.incidents_with_station(inc, st, "salted", rows_per_salt=50)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 1800
    assert max(sizes) < 600          # the hot (area 7, same spot) rows are not in one task
    assert rows(q4.station_distance(inc, st, "salted")) == rows(q4.station_distance(inc, st, "auto"))


def test_only_hot_keys_are_replicated(spark):
    big = spark.range(4000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    small = spark.range(5000).select(F.col("id").alias("sk"))
    joined = salted_join(big, small, "k", "sk", rows_per_salt=100)
    assert joined.count() == 4000
    df = joined._jdf.queryExecution()
    joined.collect()
    # The replicated side: 5,000 rows and 14 copies more of the one hot key.
    found = [int(m) for m in _generated_rows(df)]
    assert found and max(found) == 5000 + 14


def _generated_rows(execution):
    """Output rows of every Generate node of the plan that ran."""
    out, todo = [], [execution.executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName() == "Generate":
            out.append(node.metrics().apply("numOutputRows").value())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


def test_q3_auto_has_no_hint_and_aggregates_before_the_join(spark):
    inc = spark.createDataFrame([(34.0, -118.0, "H")] * 5 + [(34.1, -118.1, "W")],
                                "lat double, lon double, vict_descent string")
    geo = spark.createDataFrame([(34.0, -118.0, 1), (34.1, -118.1, 1)], "lat double, lon double, zip int")
    zips = spark.createDataFrame([(1,)], "zip int")
    auto = q3.victims_per_zip(inc, geo, zips, "auto")
    assert plan(auto).count("partial_count(1)") == 2              # both sides pre-aggregated
    assert "ResolvedHint" not in auto._jdf.queryExecution().analyzed().toString()
    small = q3.victims_per_zip(inc, geo, zips, "broadcast")
    beyond = q3.victims_per_zip(inc, geo, zips, "broadcast", max_bytes=1)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in beyond._jdf.queryExecution().analyzed().toString()
    assert rows(small) == rows(beyond) == rows(auto) == Counter({(1, "H", 5): 1, (1, "W", 1): 1})
    with pytest.raises(ValueError):
        q3.victims_per_zip(inc, geo, zips, "mrege")


def test_null_safe_join_is_inner_without_all_pairs(spark):
    left = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (2, 5, "c"), (1, None, "d"), (3, 1, "e")], "k int, w int, l string")
    right = spark.createDataFrame([(1, None, "x", 1), (1, None, "y", 0), (None, None, "z", 7), (2, 6, "q", 1), (2, 5, "r", None)],
                                  "rk int, rw int, r string, n int")
    got = null_safe_join(left, right, [("k", "rk"), ("w", "rw")])
    assert got.columns == ["k", "w", "l", "r", "n"]
    assert rows(got) == Counter([(1, None, "a", "y", 0), (None, None, "b", "z", 7), (2, 5, "c", "r", None), (1, None, "d", "y", 0)])
    with pytest.raises(ValueError):
        null_safe_join(left, right.withColumnRenamed("r", "l"), [("k", "rk")])


def test_answers_are_in_order_with_ties_broken(spark):
    from blotter.plans import q2

    inc = spark.createDataFrame([("STREET", t) for t in ("2200", "0600", "1300", "1300", "1800", None)], "premis_desc string, time_occ string")
    assert [r[0] for r in q2.street_by_daypart_text(inc).collect()] == ["AFTERNOON", "EVENING", "MORNING", "NIGHT", "OTHERWISE"]
    crimes = spark.createDataFrame([(i, a, 150, 34.0, -118.0) for i, a in enumerate([3, 2, 2, 1, 4])],
                                   "dr_no long, area int, weapon_cd int, lat double, lon double")
    st = spark.createDataFrame([(a, f"D{9 - a}", 34.1, -118.1) for a in range(1, 5)], "prec int, division string, y double, x double")
    assert [r["division"] for r in q4.station_distance(crimes, st).collect()] == ["D7", "D5", "D6", "D8"]
