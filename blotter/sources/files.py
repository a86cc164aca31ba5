"""CSV and Parquet scans and sinks.

* ``read_csv`` binds every file's columns by the names in its own header
  row, so files whose columns come in different orders line up; a declared
  column that a file lacks is an error (no inference pass over the data).
* ``write_parquet`` / ``csv_to_parquet`` are the conversion job: each
  input becomes ``<out_dir>/<stem>.parquet``, overwritten if present.
  Every conversion is one independent scan -> write job (a few run at
  once); Spark splits each file into partitions of
  ``spark.sql.files.maxPartitionBytes``.

Paths are any Hadoop file-system URI (local, HDFS, object stores).
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADERS_AT_ONCE = 32


def csv_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The data files of paths, folders and globs (names starting with ``_`` or ``.`` are no data)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out: list[str] = []
    for p in [path] if isinstance(path, str) else path:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        found = fs.globStatus(hp)
        if not found:
            raise FileNotFoundError(p)
        for status in found:
            for f in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                if f.isFile() and f.getPath().getName()[0] not in "_." and f.getLen() > 0:
                    out.append(f.getPath().toString())
    return sorted(out)


def csv_header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The names in a file's first row (compressed files included); only that row is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        text = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(text, "UTF-8")).readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.lstrip("\ufeff")]))) if line else ()


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of ``path``, grouped by their header rows.

    Only first rows are read, of ``HEADERS_AT_ONCE`` files at a time: a
    distributed read of first rows would be one of all rows.
    """
    out: dict[tuple[str, ...], list[str]] = {}
    files = csv_files(spark, path)
    with ThreadPoolExecutor(max_workers=HEADERS_AT_ONCE) as pool:
        for f, header in zip(files, pool.map(lambda f: csv_header(spark, f), files)):
            out.setdefault(header, []).append(f)
    if not out:
        raise ValueError(f"no CSV file with a header row in {path}")
    return out


def read_with_header(spark: SparkSession, files: list[str], header: tuple[str, ...]) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").csv(files))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """CSV files, each with a header row, their columns bound by name.

    With a ``schema`` its columns come out, in its order, cast to its types
    (text that is not of the type becomes null); a file that lacks one of
    them is an error and further columns are dropped. Without one all
    columns come out as text, and files must have the same names.
    """
    parts = []
    for header, files in files_by_header(spark, path).items():
        df = read_with_header(spark, files, header)
        if schema is not None:
            missing = [f.name for f in schema if f.name not in header]
            if missing:
                raise ValueError(f"{files[0]} lacks the columns {missing}; its header is {list(header)}")
            df = df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
        parts.append(df)
    return reduce(lambda a, b: a.unionByName(b), parts)


def common_header(spark: SparkSession, path: str | list[str]) -> T.StructType:
    """The one header of all files as a schema of text columns; an error if they differ.

    A stream binds columns by position, so it takes only files of one header.
    """
    headers = list(files_by_header(spark, path))
    if len(headers) > 1:
        raise ValueError(f"files of {path} have different headers: {[list(h) for h in headers[:3]]}")
    return T.StructType([T.StructField(n, T.StringType()) for n in headers[0]])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write ``df`` as CSV with a header row; returns ``path``."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parquet table(s) at ``path``."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    """Write ``df`` as Parquet (optionally partitioned); returns ``path``."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def parquet_name(csv_path: str, out_dir: str) -> str:
    """``.../name.csv`` -> ``<out_dir>/name.parquet``."""
    return f"{out_dir.rstrip('/')}/{PurePosixPath(csv_path.rstrip('/')).stem}.parquet"


def csv_to_parquet(spark: SparkSession, csv_paths: Iterable[str], out_dir: str,
                   schemas: dict[str, T.StructType] | None = None,
                   max_concurrent: int = 4) -> dict[str, str]:
    """Convert each CSV to ``<out_dir>/<stem>.parquet``; returns {csv path: parquet path}.

    Without a schema for a file its columns are all read as strings from
    the header, which is what a plain conversion keeps. Two inputs with one
    stem would overwrite each other: that is an error. The conversions are
    independent jobs; up to ``max_concurrent`` are submitted at once so the
    tail of one file's job overlaps the next instead of idling the cluster.
    """
    def convert(src: str) -> str:
        stem = PurePosixPath(src.rstrip("/")).stem
        schema = (schemas or {}).get(stem)
        return write_parquet(read_csv(spark, src, schema), parquet_name(src, out_dir))

    sources = list(csv_paths)
    by_target: dict[str, list[str]] = {}
    for src in sources:
        by_target.setdefault(parquet_name(src, out_dir), []).append(src)
    clash = [v for v in by_target.values() if len(v) > 1]
    if clash:
        raise ValueError(f"inputs with the same stem: {clash}")
    if max_concurrent <= 1 or len(sources) <= 1:
        return {src: convert(src) for src in sources}
    with ThreadPoolExecutor(max_workers=min(max_concurrent, len(sources))) as pool:
        return dict(zip(sources, pool.map(convert, sources)))
