"""Run a question as a Spark job on the source files.

    spark-submit blotter/__main__.py q1 --incidents a.csv b.csv --api sql --out hdfs:///out/q1
    python -m blotter q4 --incidents a.csv b.csv --stations stations.csv --strategy broadcast
    python -m blotter convert --out hdfs:///data/parquet a.csv b.csv revgeo.csv income.csv

Paths are any Hadoop file-system URI; ``--format parquet`` reads the all-text
Parquet copies written by ``convert``. Without ``--out`` the answer is shown
(``--show`` rows); with it the answer is written as Parquet (or CSV).
The session comes from ``SparkSession.builder.getOrCreate()``, so every
``spark-submit`` setting applies.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession

if __package__ in (None, ""):                      # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    __package__ = "blotter"

from blotter.operators.sets import union_all  # noqa: E402
from blotter.plans import merge_extracts, q1, q2, q3, q4  # noqa: E402
from blotter.plans.report import all_questions  # noqa: E402
from blotter.sources.files import common_header, csv_to_parquet  # noqa: E402
from blotter.sources.layouts import read_extract  # noqa: E402
from blotter.streaming import convert_available  # noqa: E402
from blotter.sources.typed import (typed_incidents, typed_income, typed_revgeo,  # noqa: E402
                                   typed_stations)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="blotter", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="command", required=True)

    def question(name: str, help_: str) -> argparse.ArgumentParser:
        q = sub.add_parser(name, help=help_)
        q.add_argument("--incidents", nargs="+", required=True, help="incident extract files")
        q.add_argument("--format", choices=["csv", "parquet"], default="csv")
        q.add_argument("--out", help="write the answer here instead of showing it")
        q.add_argument("--out-format", choices=["parquet", "csv"], default="parquet")
        q.add_argument("--show", type=int, default=100)
        return q

    a = question("q1", "three busiest months of each year")
    a.add_argument("--api", choices=["df", "sql"], default="df")
    b = question("q2", "street incidents by part of the day")
    b.add_argument("--buckets", choices=["text", "number"], default="text")
    c = question("q3", "victim descent in the richest / poorest ZIP codes (extracts are not de-duplicated)")
    c.add_argument("--revgeo", nargs="+", required=True)
    c.add_argument("--income", nargs="+", required=True)
    c.add_argument("--side", choices=["richest", "poorest", "both"], default="both")
    c.add_argument("--strategy", choices=["auto", "broadcast", "merge", "shuffle_hash"], default="auto")
    d = question("q4", "mean distance from firearm incidents to their station, per division")
    d.add_argument("--stations", nargs="+", required=True)
    d.add_argument("--strategy", choices=["auto", "broadcast", "salted", "merge", "shuffle_hash"],
                   default="auto")
    d.add_argument("--unfiltered", action="store_true", help="count every incident, not only firearms")
    d.add_argument("--udf", action="store_true", help="distance in a pandas UDF")
    d.add_argument("--rows", action="store_true", help="per-incident distances instead of the summary")
    e = sub.add_parser("all", help="every question from one de-duplication, one folder per answer")
    e.add_argument("--incidents", nargs="+", required=True, help="incident extract files (first = older)")
    e.add_argument("--stations", nargs="+", required=True)
    e.add_argument("--revgeo", nargs="+", required=True)
    e.add_argument("--income", nargs="+", required=True)
    e.add_argument("--format", choices=["csv", "parquet"], default="csv")
    e.add_argument("--out", required=True, help="folder; each answer is written to <out>/<name>")
    e.add_argument("--out-format", choices=["parquet", "csv"], default="parquet")
    conv = sub.add_parser("convert", help="CSV -> Parquet, one <stem>.parquet per input, all text")
    conv.add_argument("--out", required=True)
    conv.add_argument("--stream", action="store_true",
                      help="incremental: convert the files in one landing folder (glob) not yet "
                           "converted into one Parquet table, checkpointed under --checkpoint")
    conv.add_argument("--checkpoint", help="streaming checkpoint (default: <out>_checkpoint, so that a second run resumes)")
    conv.add_argument("csv", nargs="+")
    return p


def answer(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    def extracts(kind: str, paths: list[str]) -> list[DataFrame]:
        return [read_extract(spark, path, kind, args.format) for path in paths]

    def merged() -> DataFrame:
        return merge_extracts(*extracts("incidents", args.incidents))

    if args.command == "q1":
        inc = merged()
        return q1.top_months_sql(spark, inc) if args.api == "sql" else q1.top_months(inc)
    if args.command == "q2":
        inc = merged()
        return q2.street_by_daypart_number(inc) if args.buckets == "number" \
            else q2.street_by_daypart_text(inc)
    if args.command == "q3":
        incidents = typed_incidents(union_all(*extracts("incidents", args.incidents)))
        revgeo = typed_revgeo(union_all(*extracts("revgeo", args.revgeo)))
        income = typed_income(union_all(*extracts("income", args.income)))
        side = {"richest": q3.descent_richest, "poorest": q3.descent_poorest,
                "both": q3.descent_extremes}[args.side]
        return side(incidents, revgeo, income, args.strategy)
    if args.command == "q4":
        inc = merged()
        stations = typed_stations(union_all(*extracts("stations", args.stations)))
        if args.rows:
            return q4.distance_rows(inc, stations, args.strategy, not args.unfiltered, args.udf)
        return q4.station_distance(inc, stations, args.strategy, not args.unfiltered, args.udf)
    raise ValueError(args.command)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame | dict:
    """Parse ``argv``, run the command, and return its answer (for tests and notebooks)."""
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"blotter {args.command}").getOrCreate()
    if args.command == "convert" and args.stream:
        if len(args.csv) != 1:
            raise SystemExit("--stream takes one landing folder or glob")
        schema = common_header(spark, args.csv[0])
        return convert_available(spark, args.csv[0], args.out, schema, args.checkpoint)
    if args.command == "convert":
        done = csv_to_parquet(spark, args.csv, args.out)
        for src, dst in done.items():
            print(f"{src} -> {dst}")
        return done
    if args.command == "all":
        def read(kind: str, paths: list[str]) -> DataFrame:
            return union_all(*[read_extract(spark, p, kind, args.format) for p in paths])
        older = read_extract(spark, args.incidents[0], "incidents", args.format)
        rest = [read_extract(spark, p, "incidents", args.format) for p in args.incidents[1:]]
        answers = all_questions(older, union_all(*rest) if rest else older.limit(0),
                                typed_stations(read("stations", args.stations)),
                                typed_revgeo(read("revgeo", args.revgeo)),
                                typed_income(read("income", args.income)), typed_incidents(older))
        for name, df in answers.items():
            df.write.mode("overwrite").format(args.out_format).option("header", True) \
                .save(f"{args.out.rstrip('/')}/{name}")
        return answers
    if getattr(args, "rows", False) and not args.out:
        raise SystemExit("--rows gives one row per incident: name a folder with --out")
    df = answer(spark, args)
    if args.out:
        df.write.mode("overwrite").format(args.out_format).option("header", True).save(args.out)
    else:
        print(f"the first {args.show} rows at most; --out writes them all")
        df.show(args.show, truncate=False)
    return df


def cli() -> int:
    """Console entry point: run and report success to the shell."""
    main()
    return 0


if __name__ == "__main__":
    sys.exit(cli())
