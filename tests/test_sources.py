"""Scans, sinks, the shared folder and the streaming conversion."""

import os

import pytest
from pyspark.sql import types as T

from blotter.session import checkpoint_base, shared_dir
from blotter.sources import csv_to_parquet, parquet_name, read_csv, read_parquet, write_csv
from blotter.sources.schemas import INCIDENTS_RAW
from blotter.sources import derived
from blotter.streaming import convert_available
from conftest import SF_SMALL


def test_shared_dir_lives_under_the_checkpoint_dir(spark):
    base = checkpoint_base(spark)
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(base + "/") and b.startswith(base + "/") and a != b
    assert checkpoint_base(spark) == base          # stable within a session


def test_parquet_name_uses_the_stem():
    assert parquet_name("hdfs://nn:8020/data/income_2015.csv", "hdfs://nn:8020/out/") == \
        "hdfs://nn:8020/out/income_2015.parquet"


def test_csv_roundtrip_keeps_text_and_nulls(spark):
    raw = derived.incidents_raw(spark, SF_SMALL)
    path = write_csv(raw, f"{shared_dir(spark, 'rt')}/incidents.csv")
    back = read_csv(spark, path, INCIDENTS_RAW)
    assert back.schema == INCIDENTS_RAW
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    assert back.filter("vict_descent IS NULL").count() == raw.filter("vict_descent IS NULL").count() > 0


def test_batch_conversion_of_several_files(spark):
    base = shared_dir(spark, "conv")
    srcs = [write_csv(derived.incidents_raw(spark, SF_SMALL, p), f"{base}/in/incidents_{p}.csv")
            for p in ("a", "b")]
    out = csv_to_parquet(spark, srcs, f"{base}/out")
    assert sorted(os.path.basename(v) for v in out.values()) == ["incidents_a.parquet", "incidents_b.parquet"]
    # without a declared schema the header gives the names and every column stays text
    df = read_parquet(spark, out[srcs[0]])
    assert df.columns == INCIDENTS_RAW.fieldNames()
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert df.count() == 925


def test_streaming_conversion_is_incremental_and_exactly_once(spark):
    base = shared_dir(spark, "stream")
    write_csv(derived.incidents_raw(spark, SF_SMALL, "a"), f"{base}/in/incidents_a.csv")
    ckpt = f"{base}/checkpoint"
    first = convert_available(spark, f"{base}/in/*.csv", f"{base}/out", INCIDENTS_RAW, ckpt)
    assert first.count() == 925
    # a re-run with nothing new adds nothing
    assert convert_available(spark, f"{base}/in/*.csv", f"{base}/out", INCIDENTS_RAW, ckpt).count() == 925
    # a newly landed extract is picked up on its own
    write_csv(derived.incidents_raw(spark, SF_SMALL, "b"), f"{base}/in/incidents_b.csv")
    assert convert_available(spark, f"{base}/in/*.csv", f"{base}/out", INCIDENTS_RAW, ckpt).count() == 925 + 686


def test_configured_checkpoint_dir_is_used(tmp_path):
    """A session that names spark.checkpoint.dir gets its shared folders there."""
    import subprocess
    import sys
    import textwrap

    shared = tmp_path / "shared"
    code = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {str(__import__('conftest').ROOT)!r})
        from blotter.session import build_session, shared_dir
        s = build_session("local[1]", 1, extra={{"spark.checkpoint.dir": {str(shared)!r}}})
        print(shared_dir(s, "probe"))
        s.stop()
    """)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().splitlines()[-1].startswith(str(shared) + "/blotter/probe-")


REORDERED = ("a,b,c\n1,2,3\n", "c,a,b\n6,4,5\n", "b,x,c,a\n8,0,9,7\n")


def _written(folder, texts=REORDERED):
    folder.mkdir()
    for i, t in enumerate(texts):
        (folder / f"f{i}.csv").write_text(t)
    return folder


@pytest.mark.parametrize("as_path", [lambda d: str(d), lambda d: f"{d}/*.csv", lambda d: [str(p) for p in sorted(d.iterdir())]])
def test_csv_columns_are_bound_by_header_name(spark, tmp_path, as_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])
    got = read_csv(spark, as_path(_written(tmp_path / "in")), schema)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "2", "3"), ("4", "5", "6"), ("7", "8", "9")]


def test_a_missing_column_is_an_error(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "abcd"])
    with pytest.raises(ValueError, match="lacks"):
        read_csv(spark, str(_written(tmp_path / "in")), schema)
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "none"), schema)


def test_extracts_of_different_layouts_line_up(spark, tmp_path):
    from blotter.sources.layouts import read_extract

    d = _written(tmp_path / "in", ("PREC,DIVISION,X,Y\n1,N,2.5,3.5\n", "Y,X, DIVISION ,PREC\n30,20,S,2\n"))
    got = read_extract(spark, [str(p) for p in sorted(d.iterdir())], "stations")
    assert sorted(tuple(r) for r in got.select("prec", "division", "x", "y").collect()) == [("1", "N", "2.5", "3.5"), ("2", "S", "20", "30")]


def test_compressed_files_have_headers_too(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "f.csv.gz", "wt") as f:
        f.write("b,a\n2,1\n")
    assert read_csv(spark, str(tmp_path / "f.csv.gz")).select("a", "b").first() == ("1", "2")


def test_equal_stems_are_an_error(spark, tmp_path):
    _written(tmp_path / "x"), _written(tmp_path / "y")
    with pytest.raises(ValueError, match="same stem"):
        csv_to_parquet(spark, [f"{tmp_path}/x/f0.csv", f"{tmp_path}/y/f0.csv"], str(tmp_path / "out"))


def test_a_second_stream_run_resumes_without_a_named_checkpoint(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])
    d, out = _written(tmp_path / "in", REORDERED[:1]), str(tmp_path / "out")
    assert convert_available(spark, f"{d}/*.csv", out, schema).count() == 1
    (d / "g.csv").write_text("a,b,c\n4,5,6\n")
    assert convert_available(spark, f"{d}/*.csv", out, schema).count() == 2
    with pytest.raises(ValueError, match="another checkpoint"):
        convert_available(spark, f"{d}/*.csv", out, schema, checkpoint=str(tmp_path / "other"))


def test_a_stream_stops_at_a_reordered_header(spark, tmp_path):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in "abc"])
    d = _written(tmp_path / "in", REORDERED[:2])
    with pytest.raises(Exception, match="f1.csv"):
        convert_available(spark, f"{d}/*.csv", str(tmp_path / "out"), schema)


def test_a_rewritten_table_is_read_anew(spark, tmp_path):
    at = str(tmp_path / "nation.parquet")
    for n in (3, 5):
        spark.range(n).withColumnRenamed("id", "n_nationkey").write.mode("overwrite").parquet(at)
        assert derived.table(spark, str(tmp_path), "nation", "n_nationkey").count() == n
