"""Helpers the operators share: table scans, written intermediates, size settings."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from ..session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The columns ``cols`` of a table of ``sf_dir``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


LISTINGS = "spark.sql.hive.filesourcePartitionFileCacheSize"


def write_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet into the shared folder; the table read back, and its path.

    This cuts the lineage: what follows depends on files that every executor
    can read, not on shuffle files of one that may be lost. Spark's cache of
    file listings is off for the reading: the driver would keep the names of
    all files of each of these tables, which is read by this frame alone,
    long after they are deleted.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    before = spark.conf.get(LISTINGS)
    spark.conf.set(LISTINGS, "0")
    try:
        return spark.read.schema(df.schema).parquet(path), path
    finally:
        spark.conf.set(LISTINGS, before)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete written intermediates that no later step reads."""
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps whose frames are gone, and the tables they broadcast.

    It deletes them when the driver collects its garbage, which may else
    happen long after an iterative operator has moved on. The driver holds
    every broadcast table until then, so a loop of joins calls this in each
    round.
    """
    gc.collect()
    spark._jvm.System.gc()


FILTER_WORDS = 1 << 18


def likely_in(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose integer ``key`` is in the one column of ``wanted``, and few others.

    A Bloom filter of ``FILTER_WORDS`` 64-bit words, two bits of one word per
    key, so what is broadcast has at most that many rows. It saves the
    shuffle of an exact join most rows that the join would drop; that inner
    join must follow. The more keys, the more others pass (about 4 % with two
    million); none that is wanted is ever lost.
    """
    def place(k: Column) -> tuple[Column, Column]:
        h = F.xxhash64(k.cast("bigint"))
        bit = lambda shift: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int"))
        return F.pmod(h, F.lit(FILTER_WORDS)), bit(24).bitwiseOR(bit(40))

    word, bits = place(F.col(wanted.columns[0]))
    words = wanted.select(word.alias("llm_word"), bits.alias("llm_bits")).groupBy("llm_word").agg(F.bit_or("llm_bits").alias("llm_bits"))
    word, bits = place(F.col(key))
    return (df.withColumns({"llm_at": word, "llm_mask": bits}).join(F.broadcast(words), F.col("llm_at") == F.col("llm_word"))
            .filter(F.col("llm_bits").bitwiseAND(F.col("llm_mask")) == F.col("llm_mask")).select(*df.columns))


def map_batches(df: DataFrame, keep: list[str], fn: Callable[[], Callable[[pa.RecordBatch], dict]],
                fields: dict[str, pa.DataType]) -> DataFrame:
    """The columns ``keep`` of ``df`` as they are, and those that ``fn()(batch)`` makes of an Arrow batch.

    ``fn`` is called once per task and returns the function of a batch; that
    returns one list or Arrow array per name in ``fields``. Kept columns pass
    through as Arrow arrays, so null and large integers stay exact.
    """
    schema = T.StructType([df.schema[c] for c in keep] +
                          [T.StructField(n, from_arrow_type(t)) for n, t in fields.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = fn()
        for batch in batches:
            made = each(batch)
            arrays = [batch.column(c) for c in keep]
            arrays += [a if isinstance(a := made[n], pa.Array) else pa.array(a, type=t) for n, t in fields.items()]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *fields])

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A batch's texts; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, max_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text, label) of at most ``per_class`` documents of each label, of those of at most ``max_chars`` characters.

    ``labels`` has (id, label) with one row per id. The documents are chosen
    by a hash of their ids, so they are the same whatever the partitions;
    only ids are moved to choose them, and the table of chosen ids, at most
    2 * ``per_class`` rows, is what is broadcast to fetch their texts. Of
    several texts of one id the least is taken, so there are no more texts
    than ids.
    """
    fitting = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).filter(F.length("text") <= max_chars)
    present = labels.join(fitting.select("id"), "id", "left_semi")
    chosen = [r["id"] for label in (0, 1) for r in present.filter(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class).collect()]
    few = docs.sparkSession.createDataFrame([(i,) for i in chosen], T.StructType([T.StructField("id", labels.schema["id"].dataType)]))
    few = F.broadcast(few.join(labels, "id"))
    return fitting.join(few, "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("id", "text", "label")


def in_one_task(sample: DataFrame, fn: Callable[[list[str], list[int]], bytes]) -> bytes:
    """``fn`` of the texts and labels of a bounded sample (id, text, label), in order of label and text, run by an executor.

    So neither the texts nor what a model needs to be fitted are in the driver, which only gets the result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((t, y) for b in batches for t, y in zip(texts(b, "text"), b.column("label").to_pylist())), key=lambda r: (r[1], r[0]))
        made = fn([t for t, _ in rows], [y for _, y in rows])
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["made"])

    # An empty sample may have no task.
    row = sample.select("text", "label").repartition(1).mapInArrow(run, "made binary").first()
    return bytes(row["made"]) if row else fn([], [])
