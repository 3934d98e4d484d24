"""Two-leg trips over a record stream, kept in tables or per arrival window."""

from __future__ import annotations

import datetime
import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from skyledger.functions import clock
from skyledger.operators.legs import (
    best_legs, by_leg, least_delayed, only_leg, pair_legs, timed_legs, with_meeting,
)
from skyledger.schemas import LEG_KEY, LEGS, MEETING, STORED_LEGS, TRIP_KEY, TRIPS
from skyledger.sinks.buckets import BucketedFolders
from skyledger.sinks.snapshots import Snapshots, Table, Version
from skyledger.sources.records import flights_from_lines
from skyledger.streaming.runs import BATCH_SECONDS, WINDOWED_BATCH_SECONDS, each_batch, start

# Seconds an arrival window spans, and seconds between two windows.
WINDOW_SECONDS = 12
SLIDE_SECONDS = 6


# Batches between two folds: a batch reads the changes since the last one.
FOLD_LEGS_EVERY = 25


class TripTables:
    """The stored legs of both half-days and the trips they combine to.

    Both are published together: a reader sees the legs and the trips of the same batch,
    whatever is being written. Rows are ordered by the batch ids of one stream, so the
    tables belong to that stream's checkpoint: a fresh checkpoint needs a fresh path.

    Legs are stored in buckets by where and when they meet others, so a batch finds the newest
    legs and pairs them without moving what is stored. `buckets` is best kept at or above the
    session's shuffle partitions, which it is by default.
    """

    def __init__(self, path: str, buckets: int | None = None):
        near = T.StructType([*STORED_LEGS.fields, T.StructField("fresh", T.BooleanType())])
        self.near = BucketedFolders(f"{path}/near", near, tuple(MEETING), buckets=buckets)
        self.tables = Snapshots(path, {
            "legs": Table(STORED_LEGS, (*LEG_KEY, *MEETING), "meet", tuple(MEETING), buckets),
            "trips": Table(TRIPS, tuple(TRIP_KEY), sort_by="origin_date"),
        })

    def trips(self, spark: SparkSession, version: Version | None = None) -> DataFrame:
        """All trips, of the newest version if none is given."""
        return self.tables.latest(spark, "trips", version).drop("batch_id")

    def legs(self, spark: SparkSession, version: Version | None = None, where: Column | None = None) -> DataFrame:
        return self.tables.latest(spark, "legs", version, where).drop("batch_id", *MEETING)

    def origins(self, spark: SparkSession) -> DataFrame:
        """Best morning legs, keyed by (destination, date, origin)."""
        return self.legs(spark, where=F.col("leg") == "am").drop("leg")

    def destinations(self, spark: SparkSession) -> DataFrame:
        """Best afternoon legs, keyed by (origin, date, destination)."""
        return self.legs(spark, where=F.col("leg") == "pm").drop("leg")

    def legs_at(self, spark: SparkSession, destination: str, date) -> DataFrame:
        """Morning legs reaching an airport on a date."""
        wanted = (F.col("leg") == "am") & (F.col("destination") == F.lit(destination)) & (F.col("date") == F.lit(date))
        return self.legs(spark, where=wanted).drop("leg")

    def legs_at_millis(self, spark: SparkSession, destination: str, millis: int) -> DataFrame:
        """The same for a date given as epoch milliseconds."""
        return self.legs_at(spark, destination, clock.from_epoch_millis(F.lit(millis)).cast("date"))

    def store_legs(self, spark: SparkSession, legs: DataFrame, batch_id: int) -> None:
        """Store legs alone, as one batch."""
        self.tables.publish(spark, batch_id, {"legs": self.tables.write(with_meeting(legs), "legs", batch_id)})

    def store_batch(self, spark: SparkSession, legs: DataFrame, batch_id: int) -> None:
        """Store the legs a batch brought, and every trip they renew.

        Changed morning legs meet all afternoon legs and the other way round, so a leg
        counts whichever half arrives first, and a leg that improved renews every trip
        it is part of. Only stored legs that meet on dates of the batch's legs are read, as
        they were before the batch, also when the batch is replayed.

        The batch's legs are shuffled once, into the buckets of the stored ones. A group that
        got records but kept its best leg renews nothing.
        """
        arrived = self.tables.write(with_meeting(legs), "legs", batch_id)
        # One row whatever the batch holds.
        span = self.tables.read(spark, arrived, "legs").agg(F.min("meet"), F.max("meet")).first()
        if span[0] is None:
            return
        self.near.remove(spark, self.near.folders(spark))  # of an attempt that was stopped
        near = self.near.write(self.merged(spark, arrived, batch_id, *span), f"{batch_id}-{uuid.uuid4().hex}")
        near = self.near.read(spark, [near])
        changed = near.where("fresh")
        written = {"legs": self.tables.write(changed, "legs", batch_id)}
        written["trips"] = self.tables.write(self.renewed(near), "trips", batch_id)
        self.tables.publish(spark, batch_id, written)

    def merged(
        self, spark: SparkSession, arrived: str, batch_id: int, first: datetime.date, last: datetime.date
    ) -> DataFrame:
        """The newest legs that meet from `first` to `last`, `fresh` where the folder `arrived` changed them.

        One scan of earlier folders and the new one, and one aggregate without a shuffle.
        """
        earlier = self.tables.open(spark, before=batch_id)
        rows = self.tables.rows(spark, "legs", [*earlier.name("legs"), arrived], by_bucket=True)
        rows = rows.where(F.col("meet").between(first, last) | F.col("meet").isNull())
        values = [c for c in LEGS.fieldNames() if c not in LEG_KEY]
        version = F.struct("batch_id", *values)
        known = rows.groupBy(*LEG_KEY, *MEETING).agg(
            F.max(version).alias("now"), F.max(F.when(F.col("batch_id") < batch_id, version)).alias("before")
        )
        # A leg without an earlier one differs from it in its delay, which is never null.
        differs = [~F.col(f"now.{c}").eqNullSafe(F.col(f"before.{c}")) for c in values]
        fresh = (F.col("now.batch_id") == batch_id) & functools.reduce(Column.__or__, differs)
        return known.select(*LEG_KEY, *MEETING, *[f"now.{c}" for c in values], fresh.alias("fresh"))

    @staticmethod
    def renewed(near: DataFrame) -> DataFrame:
        """The trips of legs of which one at least is fresh; both sides lie in the same buckets."""
        am, pm = only_leg(near, "am"), only_leg(near, "pm")
        onward = pair_legs(am.where("fresh"), pm, meeting=True)
        # Fresh morning legs are already paired.
        return onward.unionByName(pair_legs(am.where("NOT fresh"), pm.where("fresh"), meeting=True))

    def fold(self, spark: SparkSession, batch_id: int, every: int) -> None:
        """Fold the stored legs, which every batch reads, and the trips."""
        self.tables.fold(spark, batch_id, every)


def incremental_trips(
    topic: DataFrame, tables: TripTables, checkpoint: str,
    year: int | None = None, pm_from_hour: int = 12, seconds: int | None = BATCH_SECONDS,
    session: SparkSession | None = None, fold_every: int = FOLD_LEGS_EVERY,
) -> StreamingQuery:
    """Keeps the trip table current: one streaming aggregate, then joins of what changed.

    The best leg per half-day, route and date is the state of a streaming aggregate;
    update mode hands each batch the legs whose group received records. `session` is
    used for the joins, where adaptive execution may choose and split them. Stored
    legs and trips are folded every `fold_every` batches.
    """
    joins = session or topic.sparkSession
    flights = flights_from_lines(topic)
    if year is not None:
        flights = flights.where(F.col("year") == year)
    legs = best_legs(timed_legs(flights, pm_from_hour))

    def handle(updated: DataFrame, batch_id: int) -> None:
        tables.store_batch(joins, updated, batch_id)
        tables.fold(joins, batch_id, fold_every)

    return each_batch(legs, handle, checkpoint, "update", seconds)


def joined_trips(
    topic: DataFrame, out: str, checkpoint: str,
    year: int | None = None, pm_from_hour: int = 12,
    seconds: int | None = WINDOWED_BATCH_SECONDS, late_seconds: int = WINDOW_SECONDS,
) -> StreamingQuery:
    """The trips of `windowed_trips`, as one streaming plan: two windowed aggregates, joined.

    Each half-day has its own watermark, and the stream's is the lesser of the two: a window
    closes once records of both halves came `late_seconds` after its end. Legs of a closed
    window leave the aggregates for the join, which holds them until its own watermark
    passes the window; so state ends with the windows, whatever the stream's length. Rows go
    to Parquet files whose log names each batch's files once, also if a batch is replayed.

    The topic is read by both halves, with their filters at the scan. `windowed_trips` reads
    it once but pairs legs outside the streaming plan.
    """
    window = F.window("arrival_time", f"{WINDOW_SECONDS} seconds", f"{SLIDE_SECONDS} seconds")

    def half(leg: str) -> DataFrame:
        arrived = topic.withWatermark("timestamp", f"{late_seconds} seconds")
        flights = flights_from_lines(arrived, keep=["timestamp"])
        if year is not None:
            flights = flights.where(F.col("year") == year)
        legs = only_leg(timed_legs(flights.withColumnRenamed("timestamp", "arrival_time"), pm_from_hour), leg)
        best = legs.groupBy(*by_leg(), window).agg(least_delayed().alias("best"))
        # The aggregate's own window column carries the watermark into the join.
        return best.select("window", "best.*")

    pairs = pair_legs(half("am"), half("pm"), also_on=["window"])
    rows = pairs.withColumn("window_start", F.unix_seconds("window.start")).drop("window")
    return start(rows.writeStream.outputMode("append").format("parquet").option("path", out), checkpoint, seconds)


def windowed_trips(
    topic: DataFrame, out: str, checkpoint: str,
    year: int | None = None, pm_from_hour: int = 12,
    seconds: int | None = WINDOWED_BATCH_SECONDS, session: SparkSession | None = None,
    late_seconds: int = WINDOW_SECONDS,
) -> StreamingQuery:
    """Trips whose two legs arrive within one sliding window, written once per closed window.

    A record that arrives more than `late_seconds` behind the newest before its batch is
    dropped, so they must cover what batches mix up (`runs.dropped_rows` tells).

    Append mode releases all legs of a window in the batch that closes it, so the
    pairing is a plain join inside that batch: the stream is read once, and no join
    state is kept next to the aggregate's.
    """
    joins = session or topic.sparkSession
    arrived = topic.withWatermark("timestamp", f"{late_seconds} seconds")
    flights = flights_from_lines(arrived, keep=["timestamp"])
    if year is not None:
        flights = flights.where(F.col("year") == year)
    legs = timed_legs(flights.withColumnRenamed("timestamp", "arrival_time"), pm_from_hour)
    window = F.window("arrival_time", f"{WINDOW_SECONDS} seconds", f"{SLIDE_SECONDS} seconds")
    closed = (
        legs.groupBy(*by_leg(), window)
        .agg(least_delayed().alias("best"))
        .select(F.unix_seconds("window.start").alias("window_start"), "best.*")
    )

    def handle(batch: DataFrame, batch_id: int) -> None:
        stored = f"{out}/legs/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(stored)
        legs = joins.read.schema(batch.schema).parquet(stored)
        pairs = pair_legs(only_leg(legs, "am"), only_leg(legs, "pm"), also_on=["window_start"])
        pairs.write.mode("overwrite").parquet(f"{out}/trips/batch_id={batch_id}")
        files = joins._jvm.org.apache.hadoop.fs.Path(stored)
        # the pairs are stored; a replayed batch writes its legs again
        files.getFileSystem(joins._jsc.hadoopConfiguration()).delete(files, True)

    return each_batch(closed, handle, checkpoint, "append", seconds)
