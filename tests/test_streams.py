"""Streams fed in several triggers with a restart in between, against the batch results."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter.operators import union_distinct
from blotter.plans import q1, q2, q4
from blotter.plans.incidents import merge_extracts
from blotter.session import shared_dir
from blotter.sources import derived
from blotter.sources.files import write_csv
from blotter.sources.schemas import INCIDENTS_RAW
from blotter.streaming import Answers, WindowCounts, count_available, deduplicate_available, update_available
from conftest import SF_SMALL

DAY = dt.datetime(2024, 1, 1)
HOUR = 3600


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def local(path):
    return path.removeprefix("file:")


# --- windows with a side table -----------------------------------------

def arrivals():
    """Batches of (id, kind, time): mostly in order, some a little late, some far too late, some without time."""
    out, n = [], 0
    for b in range(5):
        part = []
        for i in range(40):
            lag = 0 if i % 5 else 2 if i % 3 else 30
            t = None if i % 19 == 7 else DAY + dt.timedelta(hours=10 * b + i / 4 - lag)
            part.append((n, "ab"[i % 2] if i % 11 else None, t))
            n += 1
        out.append(part)
    return out


def brute_windows(batches, width, delay):
    mark, aside, counts = None, Counter(), Counter()
    for part in batches:
        seen = []
        for n, kind, t in part:
            if t is None:
                aside[n, "no time"] += 1
                continue
            s = int((t - dt.datetime(1970, 1, 1)).total_seconds() // 1)
            start = s // width * width
            if mark is not None and start + width <= mark:
                aside[n, "late"] += 1
            else:
                counts[kind, start] += 1
                seen.append(s)
        if seen:
            mark = max(filter(lambda x: x is not None, (mark, max(seen) - delay)))
    split = lambda closed: Counter({(*k, n): 1 for k, n in counts.items() if (k[1] + width <= mark) == closed})
    return split(True), split(False), aside


def land(spark, df, base, name):
    df.write.parquet(f"{base}/in/{name}")


def test_windows_and_late_rows_count_every_row(spark):
    base, schema = shared_dir(spark, "windows"), "id int, kind string, t timestamp_ntz"
    batches = arrivals()
    make = lambda part: spark.createDataFrame(part, schema).coalesce(1)
    for b, part in enumerate(batches):
        land(spark, make(part), base, b)
        # Each call is a new stream on the old checkpoint: a restart.
        counts = count_available(spark, f"{base}/in/*", base, make(part).schema, "t", ["kind"], 6 * HOUR, 3 * HOUR)
    closed, still, aside = brute_windows(batches, 6 * HOUR, 3 * HOUR)
    assert closed and still and {w for _, w in aside} == {"late", "no time"}
    assert rows(counts.closed()) == closed and rows(counts.open()) == still
    assert Counter((r["id"], r["why"]) for r in counts.aside().collect()) == aside
    total = sum(n * v for (*_, n), v in (rows(counts.closed()) + rows(counts.open())).items()) + counts.aside().count()
    assert total == sum(map(len, batches))


def test_a_repeated_batch_changes_nothing(spark):
    batches = arrivals()
    df = [spark.createDataFrame(p, "id int, kind string, t timestamp_ntz") for p in batches]
    counts = WindowCounts(spark, shared_dir(spark, "replay"), df[0].schema, "t", ["kind"], 6 * HOUR, 3 * HOUR)
    for b, part in enumerate(df):
        counts.add(part, b)
        counts.add(part, b)
    closed, still, aside = brute_windows(batches, 6 * HOUR, 3 * HOUR)
    assert rows(counts.closed()) == closed and rows(counts.open()) == still and counts.aside().count() == sum(aside.values())


def test_windows_without_rows_or_times(spark):
    schema = spark.createDataFrame([], "id int, kind string, t timestamp_ntz").schema
    counts = WindowCounts(spark, shared_dir(spark, "empty"), schema, "t", ["kind"], HOUR, 0)
    assert counts.closed().count() == counts.open().count() == counts.aside().count() == 0
    counts.add(spark.createDataFrame([], schema), 0)
    counts.add(spark.createDataFrame([(1, "a", None)], schema), 1)
    counts.add(spark.createDataFrame([(2, "a", DAY)], schema), 2)
    assert counts.closed().count() == 0 and counts.open().count() == 1 and counts.aside().count() == 1
    with pytest.raises(ValueError):
        WindowCounts(spark, "x", schema, "t", ["kind"], 0, 0)


# --- de-duplication -----------------------------------------------------

def test_reexported_extracts_equal_the_distinct_union(spark):
    base = shared_dir(spark, "dedup")
    a, b = (derived.incidents_raw(spark, SF_SMALL, part) for part in "ab")
    run = lambda: deduplicate_available(spark, f"{base}/in/*", f"{base}/out", INCIDENTS_RAW, f"{base}/state", max_files=2)
    write_csv(a.repartition(3), f"{base}/in/1")
    first = run().count()
    assert first == a.distinct().count()
    write_csv(b.repartition(2), f"{base}/in/2")
    write_csv(a.unionByName(a).repartition(2), f"{base}/in/3")
    out = run()
    assert rows(out) == rows(union_distinct(a, b))
    assert run().count() == out.count()


def test_a_copy_after_the_horizon_is_a_new_row(spark):
    base = shared_dir(spark, "horizon")
    one = derived.incidents_raw(spark, SF_SMALL, "a").limit(5)
    now = dt.datetime(2024, 5, 1).timestamp()
    for name, days in (("1", 0), ("2", 3), ("3", 90), ("4", 91)):
        write_csv(one.coalesce(1), f"{base}/in/{name}")
        folder = local(f"{base}/in/{name}")
        for f in os.listdir(folder):
            os.utime(f"{folder}/{f}", (now + days * 86400,) * 2)
        # One trigger per file: the state is swept between them.
        out = deduplicate_available(spark, f"{base}/in/*", f"{base}/out", INCIDENTS_RAW, f"{base}/state", horizon="30 days")
        if name == "2":
            assert out.count() == 5
    assert out.count() == 10


# --- incremental answers ------------------------------------------------

def test_answers_after_deltas_equal_the_full_run(spark):
    base = shared_dir(spark, "answers")
    a, b = (derived.incidents_raw(spark, SF_SMALL, part) for part in "ab")
    stations = derived.stations(spark, SF_SMALL)
    parts = [a.filter("CAST(dr_no AS int) % 2 = 0"), a, b]
    for i, part in enumerate(parts):
        write_csv(part.coalesce(1), f"{base}/in/{i}")
        answers = update_available(spark, f"{base}/in/*", base, INCIDENTS_RAW, stations)
    merged = merge_extracts(a, b)
    assert rows(answers.top_months()) == rows(q1.top_months(merged))
    assert rows(answers.street_by_daypart()) == rows(q2.street_by_daypart_text(merged))
    want = {r[0]: r[1:] for r in map(tuple, q4.station_distance(merged, stations).collect())}
    got = [tuple(r) for r in answers.station_distance().collect()]
    assert {g[0]: g[2] for g in got} == {k: v[1] for k, v in want.items()}
    assert all(abs(g[1] - want[g[0]][0]) < 2e-6 for g in got)
    # Most incidents first, then by name.
    assert got == sorted(got, key=lambda r: (-r[2], r[0]))


def test_a_replayed_delta_is_counted_once(spark):
    raw = derived.incidents_raw(spark, SF_SMALL, "a")
    halves = [raw.filter("CAST(dr_no AS int) % 2 = 0"), raw.filter("CAST(dr_no AS int) % 2 = 1")]
    answers = Answers(spark, shared_dir(spark, "replayed"), derived.stations(spark, SF_SMALL))
    for batch, part in enumerate(halves):
        answers.add(part, batch)
        answers.add(part, batch)
    assert rows(answers.top_months()) == rows(q1.top_months(merge_extracts(raw)))
    assert answers.station_distance().agg(F.sum("number_of_incidents")).first()[0] == q4.station_distance(merge_extracts(raw), derived.stations(spark, SF_SMALL)).agg(F.sum("number_of_incidents")).first()[0]
