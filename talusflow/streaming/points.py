"""Streams of points and messages.

Sources are landing folders; every query keeps its offsets and state under the shared folder,
so a restart continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from talusflow.functions.scalars import message
from talusflow.operators.indexing import with_number_per_key
from talusflow.session import remove, work_folder
from talusflow.streaming.state import BatchState


def read_points_stream(spark: SparkSession, path: str, schema: T.StructType,
                       file_format: str = "json", files_per_trigger: int | None = None,
                       name_filter: str | None = None) -> DataFrame:
    """Rows of the files that arrive in a folder."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def dedup_stream(df: DataFrame, keys: list[str], event_time: str, delay: str = "1 hour",
                 spread: int = 1) -> DataFrame:
    """Drop repeats that arrive within `delay`; older keys leave the state.

    With `spread` above 1, the copies of a key first meet in that many groups, and the second
    pass sees one copy per group: a message that is delivered very often then does not fill one
    task. It costs a second state of the keys.
    """
    stamped = df.withWatermark(event_time, delay)
    if spread > 1:
        stamped = (
            stamped.withColumn("_group", F.floor(F.rand() * spread).cast("int"))
            .dropDuplicatesWithinWatermark([*keys, "_group"])
            .drop("_group")
        )
    return stamped.dropDuplicatesWithinWatermark(keys)


def count_stream(df: DataFrame, *topic: str) -> DataFrame:
    """Running number of messages, in all or per topic."""
    return df.groupBy(*topic).agg(F.count(F.lit(1)).alias("n_received"))


def log_file_arrivals(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A row per arrived file with its number of rows, in a log that each batch adds to.

    A file arrives whole in one batch, so a batch counts its own files and nothing has to be
    remembered: there is no state, and a batch writes only its own rows. A repeated batch
    overwrites its folder.
    """
    named = df.select(F.col("_metadata.file_name").alias("file_name"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows")).write.mode(
            "overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        named.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def to_messages(df: DataFrame, text: str, number: str, topic: str) -> DataFrame:
    """(topic, payload) rows; the payload is `text [number]` as a JSON string."""
    return df.select(F.col(topic).alias("topic"), _payload(text, number).alias("payload"))


def _payload(text: str, number: str) -> Column:
    # A JSON array of one string, without its brackets.
    quoted = F.to_json(F.array(message(text, number)))
    return quoted.substr(F.lit(2), F.length(quoted) - 2)


def numbered_messages(df: DataFrame, text: str, topic: str, order_by: list[str],
                      last: DataFrame | None = None) -> DataFrame:
    """Messages that count on per topic: topic, number, payload.

    The first message of a topic in the order of `order_by` gets the number after its `last` one
    (topic, last), or 1. Numbers have no gaps; topics of any size are numbered by many tasks.
    """
    numbered = with_number_per_key(df, topic, order_by, "_number")
    if last is not None:
        known = last.select(F.col("topic").alias("_topic"), F.col("last").alias("_last"))
        numbered = numbered.join(known, F.col(topic).eqNullSafe(F.col("_topic")), "left").withColumn(
            "_number", F.col("_number") + F.coalesce("_last", F.lit(0)))
    return numbered.select(F.col(topic).alias("topic"), F.col("_number").alias("number"),
                           _payload(text, "_number").alias("payload"))


_LAST = T.StructType([T.StructField("topic", T.StringType()), T.StructField("last", T.LongType())])


def publish_stream(df: DataFrame, text: str, topic: str, order_by: list[str], path: str,
                   checkpoint: str) -> StreamingQuery:
    """Publish a stream as numbered messages, one folder per batch.

    The last number of each topic goes from batch to batch; a repeated batch starts from the same
    numbers and overwrites its folder.
    """
    spark = df.sparkSession
    state = BatchState(spark, f"{checkpoint}/numbers", {"last": _LAST})

    def write(batch: DataFrame, batch_id: int) -> None:
        with work_folder(spark):
            last = state.read("last", batch_id)
            out = f"{path}/batch_id={batch_id}"
            numbered_messages(batch, text, topic, order_by, last).write.mode("overwrite").parquet(out)
            counted = spark.read.schema("topic string, number long").parquet(out).groupBy("topic").agg(
                F.max("number").alias("last"))
            state.write("last", counted.union(last).groupBy("topic").agg(F.max("last").alias("last")), batch_id)

    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/offsets")
        .trigger(availableNow=True).start()
    )


def write_files(df: DataFrame, path: str, checkpoint: str, file_format: str = "parquet"
                ) -> StreamingQuery:
    """Append to files, each input row once, and stop when the present input is done."""
    return (
        df.writeStream.format(file_format).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def write_snapshots(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest complete result of an aggregation as a table.

    Each batch writes a folder of its own; the one before it stays for readers that have begun.
    """
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        remove(spark, f"{path}/batch_id={batch_id - 2}")

    return (
        df.writeStream.outputMode("complete").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The result of the last batch of `write_snapshots`."""
    batches = spark.read.parquet(path)
    last = batches.agg(F.max("batch_id")).scalar()
    return batches.where(F.col("batch_id") == last).drop("batch_id")


def score_stream(df: DataFrame, score: Callable[[DataFrame, int], DataFrame], path: str,
                 checkpoint: str) -> StreamingQuery:
    """Score each batch with a function of its rows and its number, and write it by region.

    A repeated batch overwrites its own folder, so a restart leaves no double rows.
    """
    spark = df.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        with work_folder(spark):
            score(batch, batch_id).write.mode("overwrite").partitionBy("region").parquet(
                f"{path}/batch_id={batch_id}")

    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
