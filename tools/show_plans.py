"""Write PLANS.md: the physical plan of each headline route.

For every route the operator tree of ``explain("formatted")`` is kept,
followed by the scan details (read schema, pushed filters). Plans are
the initial adaptive plans (before AQE re-optimises at runtime).

    python tools/show_plans.py [sf_dir] [--shuffle SCRATCH_DIR] > PLANS.md

With ``--shuffle`` the shuffle-volume table of ``tools/shuffle_bytes.py``
is appended, measured on one core with its event log in SCRATCH_DIR (a fresh folder of your own).
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blotter.plans.catalog import QUERIES  # noqa: E402
from blotter.session import build_session  # noqa: E402

ROUTES = [
    "union_distinct", "q1_top_months_df_parquet", "q1_top_months_sql_parquet", "q2_time_of_day_string",
    "q3_income_top", "q3_income_top_broadcast", "q3_income_top_merge", "q3_income_extremes",
    "q4_station_distance", "q4_station_distance_broadcast", "q4_station_distance_repartition",
    "q4_station_distance_udf",
]


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> str:
    """Operator tree, then per scan its pushed filters and read schema and
    per exchange its partitioning."""
    tree, details = text.split("\n\n\n", 1) if "\n\n\n" in text else (text, "")
    keep = []
    for block in details.strip().split("\n\n"):
        lines = block.splitlines()
        if not lines:
            continue
        head = lines[0].strip()
        if "Scan" in head:
            keep += [head] + ["  " + ln for ln in lines if ln.startswith(("PushedFilters", "ReadSchema"))]
        elif "Exchange" in head:
            args = [ln for ln in lines if ln.startswith("Arguments")]
            keep += [head + ("  " + args[0][len("Arguments: "):][:150] if args else "")]
    return tree.strip() + "\n\n" + "\n".join(keep)


SHUFFLE_NOTE = (
    "Read: Q1 and `union_distinct` shuffle every extract row once (whole-row de-duplication cannot "
    "shrink unique rows); Q2 and Q4 shuffle only the street / firearm rows because the filters run "
    "below the de-duplication; Q3's default route shuffles only its small aggregates (the geocoding "
    "rows are broadcast, incidents never move); its merge / shuffle-hash routes move pre-aggregated "
    "(point, code) rows instead of incidents.")


def shuffle_section(scratch: str, sf_dir: str) -> str:
    import subprocess
    tool = os.path.join(os.path.dirname(os.path.abspath(__file__)), "shuffle_bytes.py")
    env = dict(os.environ, BLOTTER_MASTER="local[1]")
    out = subprocess.run([sys.executable, tool, scratch, sf_dir], env=env, capture_output=True,
                         text=True, timeout=1800, check=True).stdout
    table = "\n".join(ln for ln in out.splitlines() if ln.startswith("|"))
    return ("## Shuffle volumes\n\nFrom `tools/shuffle_bytes.py` (Spark event log in a scratch folder; "
            "shuffle bytes and records written by each route's tasks), on one core.\n\n"
            f"{table}\n\n{SHUFFLE_NOTE}\n")


def main() -> None:
    args = sys.argv[1:]
    scratch = None
    if "--shuffle" in args:
        i = args.index("--shuffle")
        scratch = args[i + 1]
        del args[i:i + 2]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16, app_name="blotter-plans")
    print("# Physical plans of the headline routes\n")
    print(f"Generated by `tools/show_plans.py` on `{sf_dir}` (`local[8]`, 16 shuffle partitions). "
          "Initial adaptive plans.\n")
    for name in ROUTES:
        print(f"## {name}\n\n```")
        print(summarise(formatted(QUERIES[name](spark, sf_dir))))
        print("```\n")
    spark.stop()
    if scratch:
        print(shuffle_section(scratch, sf_dir))


if __name__ == "__main__":
    main()
