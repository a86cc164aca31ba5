"""Tables that a stream's batches write: one folder per batch, complete or not there.

A batch reads what the batch before it left and writes its own folder, which
replaces whatever an interrupted try left there. So a batch that is run
again, after a failure or a restart, gives the same tables, and the batches
before it are never touched. Its mark is written last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class BatchTables:
    """The tables of one stream under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, table: str, batch: int) -> str:
        return f"{self.base}/{table}/batch={batch:012d}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def batches(self, table: str) -> list[int]:
        """The batches that have written ``table`` whole."""
        fs, p = self._fs(f"{self.base}/{table}")
        if not fs.exists(p):
            return []
        names = [s.getPath() for s in fs.listStatus(p)]
        return sorted(int(n.getName().split("=")[1]) for n in names if n.getName().startswith("batch=") and fs.exists(self._fs(f"{n}/_SUCCESS")[1]))

    def write(self, table: str, batch: int, df: DataFrame) -> DataFrame:
        """Write the batch's table; what was written, read back."""
        df.write.mode("overwrite").parquet(self.path(table, batch))
        return self.spark.read.schema(df.schema).parquet(self.path(table, batch))

    def read(self, table: str, batch: int | None, schema: T.StructType) -> DataFrame:
        """One batch's table; no rows if ``batch`` is None."""
        if batch is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table, batch))

    def read_all(self, table: str, schema: T.StructType) -> DataFrame:
        paths = [self.path(table, b) for b in self.batches(table)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def before(self, table: str, batch: int) -> int | None:
        """The last batch before ``batch`` that has written ``table``."""
        return max((b for b in self.batches(table) if b < batch), default=None)

    def drop_before(self, table: str, batch: int) -> None:
        """Delete what batches before ``batch`` wrote."""
        for b in self.batches(table):
            if b < batch:
                fs, p = self._fs(self.path(table, b))
                fs.delete(p, True)
