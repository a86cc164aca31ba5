"""The job runner on files laid out like the public source files."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from blotter.__main__ import main
from blotter.session import shared_dir
from blotter.sources import derived, write_csv
from blotter.sources.layouts import column_names, read_extract
from conftest import SF_SMALL

QUERIES = entry.queries()


def _multiset(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def source_files(spark):
    """The derived extracts written with source-style headers and extra columns."""
    base = shared_dir(spark, "cli")

    def incidents(part, area_header):
        raw = derived.incidents_raw(spark, SF_SMALL, part)
        return raw.select(
            F.col("dr_no").alias("DR_NO"),
            F.concat(F.lit("R"), F.col("dr_no")).alias("Date Rptd"),      # columns no question reads
            F.col("date_occ").alias("DATE OCC"), F.col("time_occ").alias("TIME OCC"),
            F.col("area").alias(area_header), F.lit("34").alias("Vict Age"),
            F.col("vict_descent").alias("Vict Descent"), F.col("premis_desc").alias("Premis Desc"),
            F.col("weapon_cd").alias("Weapon Used Cd"), F.col("lat").alias("LAT"), F.col("lon").alias("LON"))

    files = {
        "a": write_csv(incidents("a", "AREA "), f"{base}/crimes_a.csv"),
        "b": write_csv(incidents("b", "AREA"), f"{base}/crimes_b.csv"),
        "revgeo": write_csv(derived.revgeo_raw(spark, SF_SMALL).select(
            F.col("lat").alias("LAT"), F.col("lon").alias("LON"), F.col("zip").alias("ZIPcode")),
            f"{base}/revgeo.csv"),
        "income": write_csv(derived.income_raw(spark, SF_SMALL).select(
            F.col("zip").alias("Zip Code"), F.col("community").alias("Community"),
            F.col("median_income").alias("Estimated Median Income")), f"{base}/income.csv"),
        "stations": write_csv(derived.stations_raw(spark, SF_SMALL).select(
            F.col("x").alias("X"), F.col("y").alias("Y"), F.col("division").alias("DIVISION"),
            F.col("prec").alias("PREC")), f"{base}/stations.csv"),
    }
    return files


def test_headers_normalise():
    assert column_names(["DR_NO", "AREA ", "Vict Age", "Weapon Used Cd"],
                        {"AREA": "area", "DR_NO": "dr_no", "Weapon Used Cd": "weapon_cd"}) == \
        ["dr_no", "area", "vict_age", "weapon_cd"]
    with pytest.raises(ValueError):
        column_names(["AREA", "AREA "], {"AREA": "area"})


def test_read_extract_keeps_every_column(spark, source_files):
    df = read_extract(spark, source_files["a"], "incidents")
    assert df.columns[:3] == ["dr_no", "date_rptd", "date_occ"] and "vict_age" in df.columns
    with pytest.raises(ValueError):
        read_extract(spark, source_files["revgeo"], "incidents")


@pytest.mark.parametrize("argv,name", [
    (["q1"], "q1_top_months_df_parquet"),
    (["q1", "--api", "sql"], "q1_top_months_sql_parquet"),
    (["q2"], "q2_time_of_day_string"),
    (["q2", "--buckets", "number"], "q2_time_of_day_int"),
    (["q4"], "q4_station_distance"),
    (["q4", "--strategy", "salted"], "q4_station_distance_repartition"),
    (["q4", "--unfiltered"], "q4_station_distance_unfiltered"),
])
def test_questions_on_source_files(spark, source_files, argv, name):
    args = argv + ["--incidents", source_files["a"], source_files["b"], "--show", "0"]
    if argv[0] == "q4":
        args += ["--stations", source_files["stations"]]
    assert _multiset(main(args, spark)) == _multiset(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("side,name", [("richest", "q3_income_top"), ("poorest", "q3_income_bottom"),
                                       ("both", "q3_income_extremes")])
def test_q3_on_source_files(spark, source_files, side, name):
    df = main(["q3", "--incidents", source_files["a"], "--revgeo", source_files["revgeo"],
               "--income", source_files["income"], "--side", side, "--strategy", "broadcast",
               "--show", "0"], spark)
    assert _multiset(df) == _multiset(QUERIES[name](spark, SF_SMALL))


def test_convert_then_query_parquet(spark, source_files):
    out = shared_dir(spark, "cli-parquet")
    done = main(["convert", "--out", out, source_files["a"], source_files["b"]], spark)
    pa, pb = done[source_files["a"]], done[source_files["b"]]
    df = main(["q1", "--format", "parquet", "--incidents", pa, pb, "--show", "0"], spark)
    assert _multiset(df) == _multiset(QUERIES["q1_top_months_df_parquet"](spark, SF_SMALL))
    written = shared_dir(spark, "cli-out")
    main(["q2", "--incidents", source_files["a"], source_files["b"], "--out", written], spark)
    assert _multiset(spark.read.parquet(written)) == _multiset(QUERIES["q2_time_of_day_string"](spark, SF_SMALL))


def test_typed_step_parses_extra_published_columns(spark, source_files):
    from blotter.sources.typed import typed_incidents
    df = typed_incidents(read_extract(spark, source_files["a"], "incidents"))
    types = dict(df.dtypes)
    assert types["vict_age"] == "int" and types["date_rptd"] == "timestamp_ntz"   # 'R<n>' text -> null
    assert df.filter("vict_age = 34").count() == df.count()


def test_streaming_convert_of_a_landing_folder(spark, source_files):
    import os
    landing = os.path.dirname(source_files["a"])
    out = shared_dir(spark, "cli-stream")
    df = main(["convert", "--stream", "--out", out, f"{landing}/crimes_*.csv"], spark)
    assert df.count() == 925 + 686
    assert "DATE OCC" in df.columns
    # A second run without a named checkpoint resumes: nothing is read twice or lost.
    assert main(["convert", "--stream", "--out", out, f"{landing}/crimes_*.csv"], spark).count() == 925 + 686


def test_rows_of_every_incident_need_an_output(source_files, spark):
    with pytest.raises(SystemExit):
        main(["q4", "--rows", "--incidents", source_files["a"], "--stations", source_files["stations"]], spark)


def test_malformed_source_lines_become_nulls(spark, tmp_path):
    from blotter.sources.typed import typed_incidents
    text = "\n".join([
        "DR_NO,DATE OCC,TIME OCC,AREA ,Premis Desc,Vict Descent,Weapon Used Cd,LAT,LON",
        "1,01/05/2010 12:00:00 AM,0930,7,STREET,H,102,34.05,-118.25",
        "2,2010-01-05,93O,  7 ,\"STREET, ALLEY\",,abc,0,0",        # bad date, bad time, junk code
        "3,01/05/2010 12:00:00 AM",                                  # too few fields
        "4,01/05/2010 12:00:00 AM,2100,7,STREET,W,150,34.1,-118.2,EXTRA",  # too many fields
    ])
    path = tmp_path / "odd.csv"
    path.write_text(text + "\n")
    df = typed_incidents(read_extract(spark, str(path), "incidents"))
    got = {r["dr_no"]: r for r in df.collect()}
    assert set(got) == {1, 2, 3, 4}
    assert got[2]["date_occ"] is None and got[2]["weapon_cd"] is None and got[2]["area"] == 7
    assert got[2]["premis_desc"] == "STREET, ALLEY"
    assert got[3]["time_occ"] is None and got[3]["lat"] is None
    assert got[4]["weapon_cd"] == 150


def test_all_questions_command(spark, source_files):
    out = shared_dir(spark, "cli-all")
    answers = main(["all", "--incidents", source_files["a"], source_files["b"],
                    "--stations", source_files["stations"], "--revgeo", source_files["revgeo"],
                    "--income", source_files["income"], "--out", out], spark)
    same = {"q1_top_months": "q1_top_months_df_parquet", "q2_time_of_day_int": "q2_time_of_day_int",
            "q3_income_extremes": "q3_income_extremes", "q4_station_distance": "q4_station_distance"}
    for mine, name in same.items():
        written = spark.read.parquet(f"{out}/{mine}")
        assert _multiset(written) == _multiset(QUERIES[name](spark, SF_SMALL)), mine
    assert set(answers) >= set(same)
