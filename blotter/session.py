"""Session construction and the shared working folder.

``build_session`` is a convenience for tests and the bench; on a cluster
the session normally comes from ``spark-submit`` and the library only
reads its settings.

``shared_dir`` returns a folder under the cluster's shared checkpoint
location (``spark.checkpoint.dir``). Intermediate tables that must
outlive an executor (CSV staging, written checkpoints) go there, never to
a machine-local temp folder. Only where the setting is absent, as in local
tests, is a folder of the application's own made and registered.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "blotter", extra: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL = re.compile(r"local(\[.*\])?")


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a session whose executors are threads of the driver
    gets a folder of its own, named after the application and removed when
    the driver ends; any other session is refused, as its executors would
    not see it.
    """
    sc = spark.sparkContext
    base = sc.getConf().get(CHECKPOINT_KEY, None)
    if not base:
        if not _LOCAL.fullmatch(sc.master):
            raise RuntimeError(
                f"{CHECKPOINT_KEY} is not set: on a cluster, intermediate tables must go to a "
                "shared file system folder, not to a machine-local temp folder")
        base = os.path.join(tempfile.gettempdir(), f"blotter-{sc.applicationId}")
        if not os.path.isdir(base):
            os.makedirs(base)
            atexit.register(shutil.rmtree, base, ignore_errors=True)
            sc.setCheckpointDir(base)
    return base.rstrip("/")


# What this process was given paths for, with what it takes to delete them.
_given: list[tuple] = []


def _delete_given() -> None:
    """Delete this process's working folders; results read from them are gone with it anyway."""
    for jvm, conf, path in _given:
        try:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        except Exception:  # noqa: BLE001 - the JVM may have ended first; nothing depends on the folder
            return


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder, deleted when the driver ends."""
    path = f"{checkpoint_base(spark)}/blotter/{'-'.join(parts + (uuid.uuid4().hex[:12],))}"
    if not _given:
        atexit.register(_delete_given)
    _given.append((spark._jvm, spark._jsc.hadoopConfiguration(), path))
    return path


def materialize(df, name: str = "table", partition_by: list[str] | None = None):
    """Write ``df`` as Parquet under the shared folder and return the table read back.

    This is the lineage cut for results reused by several jobs: the read-back
    frame depends only on files in the shared folder, so a lost executor
    never forces the upstream shuffles to be recomputed, and later plans get
    a plain Parquet scan (pushdown, pruning) instead of the whole lineage.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)
