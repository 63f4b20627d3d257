"""Tables that the batches of a stream hand on to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from talusflow.session import remove

_KEPT = 2  # a batch that is repeated reads what the one before it left


class BatchState:
    """Small or bounded tables under one folder, each written anew by every batch.

    A batch reads what the newest batch before it left, so a repeated batch starts from the same
    state and overwrites its own. Only the last folders are kept: the state is as large as its
    tables, however many batches have run.
    """

    def __init__(self, spark: SparkSession, path: str, schemas: dict[str, T.StructType]):
        self.spark, self.path, self.schemas = spark, path, schemas

    def _batches(self, name: str) -> list[int]:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.path}/{name}")
        system = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        found = [f.getPath() for f in system.listStatus(folder)]
        return sorted(int(p.getName().split("=")[1]) for p in found
                      if system.exists(hadoop.Path(p, "_SUCCESS")))

    def read(self, name: str, batch_id: int) -> DataFrame:
        """The table as the batch before `batch_id` left it; empty before the first."""
        schema = self.schemas[name]
        before = [b for b in self._batches(name) if b < batch_id]
        if not before:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/batch={before[-1]}")

    def write(self, name: str, df: DataFrame, batch_id: int) -> DataFrame:
        """Store the table for the next batch, drop what no repeat can need, and read it back."""
        schema, path = self.schemas[name], f"{self.path}/{name}/batch={batch_id}"
        df.select(*schema.fieldNames()).write.mode("overwrite").parquet(path)
        older = [b for b in self._batches(name) if b < batch_id]
        for batch in older[:-(_KEPT - 1)]:
            remove(self.spark, f"{self.path}/{name}/batch={batch}")
        return self.spark.read.schema(schema).parquet(path)
