"""Bucketed and partitioned tables by their plans, stored sketches by their errors, answers by their order."""

import random

import pytest

from blotter.operators import sketches
from blotter.plans.catalog import QUERIES
from blotter.sources import derived, drop_table, read_table, write_bucketed, write_csv
from blotter.sources.files import files_by_header
from blotter.session import shared_dir
from conftest import SF_MID, SF_SMALL


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_bucketed_tables_join_and_group_without_exchange(spark):
    p = plan(QUERIES["layout_bucketed_join"](spark, SF_SMALL))
    assert "SortMergeJoin" in p and "Exchange" not in p and "Bucketed: true" in p


def test_a_bucket_is_one_file(spark):
    df = spark.range(1000).selectExpr("id % 50 AS k", "id AS v")
    name = write_bucketed(df, "few", ["k"], 4)
    assert len(read_table(spark, name).inputFiles()) <= 4 and read_table(spark, name).count() == 1000
    drop_table(spark, name)
    with pytest.raises(ValueError):
        write_bucketed(df, "none", ["k"], 0)


def test_partitions_are_pruned_by_the_join(spark):
    df = QUERIES["layout_partition_pruned"](spark, SF_SMALL)
    p = plan(df)
    assert "dynamicpruning" in p.lower()


def test_merge_order_and_error_of_sketches(spark):
    r = random.Random(1)
    data = [(i % 7, r.choice([None, i % 3000, i]), r.choice([None, float("nan"), r.gauss(0, 1), 5.0])) for i in range(20_000)]
    df = spark.createDataFrame(data, "day int, who int, v double")
    shares = [0.0, 0.25, 0.5, 0.95, 1.0]
    days = sketches.sketch(df, ["day"], "who", "v")
    values = sorted(v for _, _, v in data if v is not None and v == v)
    true = len({w for _, w, _ in data if w is not None})
    for stored in (days.orderBy("day"), days.orderBy("day", ascending=False), sketches.merge(days.withColumn("half", days["day"] % 2), ["half"])):
        out = sketches.estimate(sketches.merge(stored, []), shares).first()
        assert out["n"] == len(data) and abs(out["distinct_estimate"] - true) <= sketches.DISTINCT_ERROR * true
        for share, q in zip(shares, out["quantile_estimates"]):
            below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
            assert below <= share + sketches.RANK_ERROR and upto >= share - sketches.RANK_ERROR
    nulls = spark.createDataFrame([(1, None, None)], "day int, who int, v double")
    out = sketches.estimate(sketches.sketch(nulls, ["day"], "who", "v"), [0.5]).first()
    assert (out["distinct_estimate"], out["quantile_estimates"]) == (0, [None])


def test_headers_of_many_files(spark):
    base = shared_dir(spark, "headers")
    raw = derived.stations_raw(spark, SF_SMALL)
    write_csv(raw.repartition(20), f"{base}/a")
    write_csv(raw.select(*reversed(raw.columns)).repartition(5), f"{base}/b")
    found = files_by_header(spark, [f"{base}/a", f"{base}/b"])
    assert {h: len(f) for h, f in found.items()} == {tuple(raw.columns): 20, tuple(reversed(raw.columns)): 5}


def ordered(df, key):
    got = [r.asDict() for r in df.collect()]
    assert len(got) > 1 and got == sorted(got, key=key)


@pytest.mark.parametrize("name", ["q2_time_of_day_string", "q2_time_of_day_int", "incremental_q2"])
def test_q2_comes_most_first_ties_by_name(spark, name):
    ordered(QUERIES[name](spark, SF_SMALL), lambda r: (-r["count"], r["time_of_day"]))


@pytest.mark.parametrize("name", ["q4_station_distance", "q4_station_distance_unfiltered", "q4_station_distance_broadcast", "q4_station_distance_repartition", "q4_station_distance_udf"])
def test_q4_comes_most_first_ties_by_division(spark, name):
    ordered(QUERIES[name](spark, SF_MID), lambda r: (-r["number_of_incidents"], r["division"]))


@pytest.mark.parametrize("name", ["q3_income_top", "q3_income_bottom", "q3_income_top_broadcast", "q3_income_top_merge", "q3_income_top_shuffle_hash"])
def test_q3_comes_by_zip_and_most_first(spark, name):
    ordered(QUERIES[name](spark, SF_MID).select("zip", "count"), lambda r: (r["zip"], -r["count"]))
