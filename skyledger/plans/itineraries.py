"""Two-leg trips: a morning flight, and two days later an afternoon one onwards."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.functions import clock
from skyledger.operators.legs import best_legs, only_leg, pair_legs, timed_legs
from skyledger.schemas import STORED_TRIPS


def trips(flights: DataFrame, pm_from_hour: int = 12) -> DataFrame:
    """Every X -> Y -> Z with the least delayed flight on each leg.

    `pm_from_hour=13` leaves out departures between noon and one o'clock.
    """
    legs = best_legs(timed_legs(flights, pm_from_hour))
    return pair_legs(only_leg(legs, "am"), only_leg(legs, "pm"))


# Bytes of a row group of stored trips: a lookup that meets one by chance reads little.
ROW_GROUP_BYTES = 16 << 20


def route_key(origin: Column, connection: Column, destination: Column) -> Column:
    """One number for a route; two routes may share it, so a lookup compares the route as well."""
    return F.xxhash64(origin, connection, destination)


def store_trips(trip_rows: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Parquet by origin date; the rebalance makes few files per date and splits big dates.

    Files are sorted by the route's number and hold a Bloom filter of it, so a lookup leaves out
    row groups that cannot hold its route, and reads only pages around it of one that may.
    """
    keyed = trip_rows.withColumn("route_key", route_key(F.col("origin"), F.col("connection"), F.col("destination")))
    (
        keyed.hint("rebalance", "origin_date").sortWithinPartitions("origin_date", "route_key")
        .write.mode("overwrite").partitionBy("origin_date")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#route_key", True)
        .option("parquet.bloom.filter.adaptive.enabled", True)
        .option("parquet.enable.dictionary#route_key", False)
        .parquet(path)
    )


def stored_trips(spark: SparkSession, path: str) -> DataFrame:
    """What `store_trips` wrote, with the column that lookups prune by."""
    return spark.read.schema(STORED_TRIPS).parquet(path).select(*STORED_TRIPS.fieldNames())


def trip_lookup(
    stored: DataFrame, origin: str, connection: str, destination: str,
    origin_date: datetime.date | str,
) -> DataFrame:
    """The trip under one full key; the date prunes folders, the rest reaches the scan.

    With the `route_key` of stored trips, the scan skips row groups and pages as well.
    """
    found = stored.where(
        (F.col("origin_date") == F.lit(origin_date).cast("date"))
        & (F.col("origin") == origin)
        & (F.col("connection") == connection)
        & (F.col("destination") == destination)
    )
    if "route_key" not in stored.columns:
        return found
    wanted = route_key(F.lit(origin), F.lit(connection), F.lit(destination))
    return found.where(F.col("route_key") == wanted).drop("route_key")


_MOMENTS = {
    "origin_date": clock.iso_date,
    "origin_date_time": clock.iso_datetime,
    "connection_date": clock.iso_date,
    "connection_date_time": clock.iso_datetime,
}


def trips_as_text(trip_rows: DataFrame) -> DataFrame:
    """Dates and times as ISO text."""
    return trip_rows.select(
        *[_MOMENTS[c](F.col(c)).alias(c) if c in _MOMENTS else F.col(c) for c in trip_rows.columns]
    )


def trips_as_millis(trip_rows: DataFrame) -> DataFrame:
    """Dates and times as epoch milliseconds."""
    return trip_rows.select(
        *[
            clock.epoch_millis(F.col(c)).alias(c) if c in _MOMENTS else F.col(c)
            for c in trip_rows.columns
        ]
    )


def legs_as_millis(legs: DataFrame) -> DataFrame:
    """Stored-leg form: epoch milliseconds, carrier, flight, route and delay."""
    return legs.select(
        clock.epoch_millis(F.col("date")).alias("date"),
        clock.epoch_millis(F.col("date_time")).alias("date_time"),
        "carrier", "flight", "origin", "destination", "arrival_delay",
    )
