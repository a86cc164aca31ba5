"""Shuffle bytes written per route, read from Spark's event log.

    python tools/shuffle_bytes.py SCRATCH_DIR [sf_dir] [route ...]
    BLOTTER_MASTER=local[1] python tools/shuffle_bytes.py ...

The event log goes to SCRATCH_DIR (a fresh folder of your own); no UI or
server is involved. Each route runs once into the ``noop`` sink under its
own job group, and the shuffle bytes its tasks wrote are summed. Prints a
Markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.plans.catalog import QUERIES  # noqa: E402
from blotter.session import build_session  # noqa: E402

DEFAULT_ROUTES = [
    "union_distinct", "q1_top_months_df_parquet", "q2_time_of_day_string",
    "q3_income_top", "q3_income_top_merge", "q3_income_top_shuffle_hash",
    "q4_station_distance", "q4_station_distance_repartition",
]


def main(argv: list[str]) -> None:
    scratch = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    routes = argv[3:] or DEFAULT_ROUTES
    master = os.environ.get("BLOTTER_MASTER", "local[8]")
    spark = build_session(master, 16, app_name="blotter-shuffle", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": scratch,
        "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    for name in routes:
        sc.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    log = sorted(glob.glob(f"{scratch}/*/events*"))[-1]
    group_of_stage: dict[int, str] = {}
    written: dict[str, int] = {}
    records: dict[str, int] = {}
    for line in open(log):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for s in e["Stage IDs"]:
                group_of_stage[s] = g
        elif e["Event"] == "SparkListenerTaskEnd":
            w = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
            g = group_of_stage.get(e["Stage ID"])
            written[g] = written.get(g, 0) + w.get("Shuffle Bytes Written", 0)
            records[g] = records.get(g, 0) + w.get("Shuffle Records Written", 0)
    print(f"Shuffle written per route on `{sf_dir}`, `{master}`:\n")
    print("| route | shuffle MB | shuffle records |")
    print("|---|---|---|")
    for name in routes:
        print(f"| {name} | {written.get(name, 0) / 1e6:.2f} | {records.get(name, 0):,} |")


if __name__ == "__main__":
    main(sys.argv)
