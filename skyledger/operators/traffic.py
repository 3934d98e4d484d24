"""Airport traffic counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def route_counts(records: DataFrame) -> DataFrame:
    """Rows per (origin, dest); a row without a year does not count.

    This is the only pass over the input. It combines on the map side, so a hub
    with a third of all rows still sends one row per route and task.
    """
    return records.groupBy("origin", "dest").agg(F.count("year").alias("n"))


def airport_totals(records: DataFrame) -> DataFrame:
    """Departures plus arrivals for every airport that has departures.

    Has left-join meaning: an airport without arrivals gets a null total, one
    without departures does not appear. Both counts come from the same small
    route table, so the input is neither scanned twice nor joined to itself.
    """
    ends = route_counts(records).select(
        F.explode(
            F.array(
                F.struct(
                    F.col("origin").alias("airport"),
                    F.col("n").alias("departures"),
                    F.lit(None).cast("bigint").alias("arrivals"),
                ),
                F.struct(
                    F.col("dest").alias("airport"),
                    F.lit(None).cast("bigint").alias("departures"),
                    F.col("n").alias("arrivals"),
                ),
            )
        ).alias("end")
    ).select("end.*")
    per_airport = ends.groupBy("airport").agg(
        F.sum("departures").alias("departures"), F.sum("arrivals").alias("arrivals")
    )
    # An equi-join never matches a null airport, so its arrivals do not count.
    arrivals = F.when(F.col("airport").isNotNull(), F.col("arrivals"))
    return per_airport.where(F.col("departures").isNotNull()).select(
        "airport", (F.col("departures") + arrivals).alias("total")
    )


def endpoints(records: DataFrame) -> DataFrame:
    """Two rows per record, one for each airport it touches; malformed lines may name none."""
    ends = records.select(F.explode(F.array("origin", "dest")).alias("airport"))
    return ends.where(F.col("airport").isNotNull())


def endpoint_counts(records: DataFrame) -> DataFrame:
    """Records touching each airport, arrivals-only airports included.

    A single aggregation, so it also runs on a stream.
    """
    return endpoints(records).groupBy("airport").agg(F.count(F.lit(1)).alias("total"))
