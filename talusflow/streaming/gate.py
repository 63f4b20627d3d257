"""Points of a stream: each gets one number, and is scored once, when its hours are there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talusflow.operators.indexing import with_row_index
from talusflow.schemas import COORD, HOURLY_FILE, HOURS
from talusflow.session import stored
from talusflow.streaming.state import BatchState

POINT = ["longitude", "latitude", "year", "month", "date", "time"]

_KNOWN = T.StructType([
    *[T.StructField(c, COORD) for c in POINT[:2]],
    *[T.StructField(c, T.IntegerType()) for c in POINT[2:5]], T.StructField("time", T.StringType()),
    T.StructField("Index", T.LongType()), T.StructField("arrived", T.TimestampType())])
_NEXT = T.StructType([T.StructField("next_index", T.LongType())])
_CLOSED = T.StructType([T.StructField("Index", T.LongType()), T.StructField("closes", T.TimestampType())])
_CLOCK = T.StructType([T.StructField("clock", T.TimestampType())])


def day_end() -> Column:
    """The end of a point's day, from its calendar columns."""
    return F.try_make_timestamp(F.col("year"), F.col("month"), F.col("date"), F.lit(0), F.lit(0), F.lit(0)
                                ) + F.make_dt_interval(days=F.lit(1))


class PointNumbers:
    """Numbers for points as they arrive; a point that comes again within `horizon` gets none.

    Kept from batch to batch: the points that arrived within the last `horizon`, whatever their own
    day, and the next number. So the state is bounded by how much arrives in that time.
    """

    def __init__(self, spark: SparkSession, path: str, horizon: str = "30 days"):
        self.state = BatchState(spark, path, {"known": _KNOWN, "next": _NEXT})
        self.horizon = F.expr(f"INTERVAL {horizon}")

    def first_seen(self, points: DataFrame, batch_id: int) -> DataFrame:
        """The points of a batch that are new, each once, with their `Index`."""
        counter = self.state.read("next", batch_id).first()  # one row
        first = counter.next_index if counter else 0
        known = self.state.read("known", batch_id)
        typed = points.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                for f in _KNOWN.fields if f.name in POINT])
        same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in POINT]
        taken = known.select(*[F.col(c).alias(f"_known_{c}") for c in POINT])
        new = with_row_index(typed.distinct().join(taken, same, "left_anti"), POINT, "Index", start=first)
        arrived = new.withColumn("arrived", F.current_timestamp())
        self.state.write("known", known.where(
            F.col("arrived") > F.current_timestamp() - self.horizon).unionByName(arrived), batch_id)
        highest = new.agg(F.max("Index")).first()[0]
        upto = first if highest is None else highest + 1
        self.state.write("next", points.sparkSession.createDataFrame([(upto,)], _NEXT), batch_id)
        return new


class HourGate:
    """Holds the hours of a point until all 24 are there, or until the watermark has passed its day.

    The watermark is the newest observed time less `delay`. A point of a day that it has passed
    leaves with the batch that brings it. A point leaves once: hours that come after it has left are
    not let in, for as long as it is remembered, which is until the watermark has moved on by
    `memory`. Kept from batch to batch: the hours of the open points and the numbers of remembered
    ones, so both are bounded by what `delay` and `memory` span.
    """

    def __init__(self, spark: SparkSession, path: str, delay: str = "1 day", memory: str = "30 days"):
        self.state = BatchState(spark, path, {"held": HOURLY_FILE, "closed": _CLOSED, "clock": _CLOCK})
        self.delay, self.memory = F.expr(f"INTERVAL {delay}"), F.expr(f"INTERVAL {memory}")

    def ready(self, hours: DataFrame, batch_id: int) -> DataFrame:
        """All hours of the points that leave the gate with this batch."""
        before = self.state.read("clock", batch_id).first()  # one row
        held, closed = self.state.read("held", batch_id), self.state.read("closed", batch_id)
        hours = stored(hours.select(*HOURLY_FILE.fieldNames()), "hours")
        both = held.unionByName(hours.join(closed, "Index", "left_anti"))
        newest = hours.agg(F.max(F.col("datetime")) - self.delay).first()[0]
        clock = max((c for c in (before.clock if before else None, newest) if c is not None), default=None)
        now = F.lit(clock).cast("timestamp")
        points = both.groupBy("Index").agg(
            F.expr("bit_or(shiftleft(1, hour(datetime)))").alias("_seen"), F.max(day_end()).alias("_ends"))
        full = F.bit_count(F.coalesce("_seen", F.lit(0))) == HOURS
        # A point without a proper day can wait for nothing.
        due = F.col("_ends").isNull() | F.coalesce(F.col("_ends") <= now, F.lit(False))
        leaving = points.withColumn("_leaves", full | due)
        marked = stored(both.join(leaving.select("Index", "_leaves"), "Index"), "marked")
        self.state.write("held", marked.where("NOT _leaves"), batch_id)
        gone = leaving.where("_leaves").select(
            "Index", (F.greatest("_ends", now) + self.memory).alias("closes")).union(closed)
        self.state.write("closed", gone.where(F.coalesce(F.col("closes") > now, F.lit(True))), batch_id)
        self.state.write("clock", hours.sparkSession.createDataFrame([(clock,)], _CLOCK), batch_id)
        return marked.where("_leaves").drop("_leaves")
