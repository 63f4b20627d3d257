"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; a cluster sets master, memory and parallelism itself.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keys that a stream remembers stay outside the heap and on disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Plans here have hundreds of columns; recording the call site of each one is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "talusflow", **settings: str) -> SparkSession:
    """A session with the package's settings; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors see: `spark.checkpoint.dir`, or a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="talusflow-")
    return _local_dirs[context.applicationId]


_work_folder: ContextVar[str | None] = ContextVar("work_folder", default=None)


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder, or the open work folder; each call gives another one."""
    return f"{_work_folder.get() or shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[str]:
    """Shared paths that are made inside lie in one folder, which is deleted at the end.

    What is still read later has to be written to a path made before.
    """
    path = shared_path(spark, "work")
    token = _work_folder.set(path)
    try:
        yield path
    finally:
        _work_folder.reset(token)
        remove(spark, path)


def stored(df: DataFrame, purpose: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The frame, written once to the shared folder and read from there by all that follows.

    With `partition_by` a reader of one value opens the files of that value only.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
