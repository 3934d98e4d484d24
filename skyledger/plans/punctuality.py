"""Mean delays by weekday, by airport and carrier, and by route."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import texts
from skyledger.operators.averages import mean_by
from skyledger.operators.ranking import first_per_group

LIST_LENGTH = 10


def weekday_delay(flights: DataFrame) -> DataFrame:
    """Weekdays by mean arrival delay, best first."""
    return mean_by(flights, ["day_of_week"], "arr_delay", "avg_delay").orderBy(
        "avg_delay", "day_of_week"
    )


def ten_best(means: DataFrame, name: str, n: int = LIST_LENGTH) -> DataFrame:
    """Per origin the `n` names with the least mean delay: (origin, rank, name, avg_delay)."""
    order = [F.col("avg_delay").asc_nulls_last(), F.col(name).asc_nulls_last()]
    return first_per_group(means, "origin", order, n).select("origin", "rank", name, "avg_delay")


def top_carriers(flights: DataFrame, n: int = LIST_LENGTH) -> DataFrame:
    return ten_best(mean_by(flights, ["origin", "carrier"], "dep_delay", "avg_delay"), "carrier", n)


def top_destinations(flights: DataFrame, n: int = LIST_LENGTH) -> DataFrame:
    return ten_best(mean_by(flights, ["origin", "dest"], "dep_delay", "avg_delay"), "dest", n)


def _ranked_names(ranked: DataFrame, item) -> DataFrame:
    # At most LIST_LENGTH rows per origin are left at this point.
    return ranked.groupBy("origin").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", item.alias("item")))), lambda x: x["item"]
        ).alias("items")
    )


def as_name_list(ranked: DataFrame, name: str, column: str) -> DataFrame:
    """One row per airport with the names in order as one text cell."""
    return _ranked_names(ranked, F.col(name)).select(
        F.col("origin").alias("airport"), texts.bag_text(F.col("items")).alias(column)
    )


def as_wide_list(ranked: DataFrame, name: str, prefix: str) -> DataFrame:
    """One row per airport with ten cells `(name, mean)`, missing places filled."""
    cells = [
        F.coalesce(F.get("items", F.lit(i)), F.lit(texts.NO_ENTRY)).alias(f"{prefix}{i + 1:02d}")
        for i in range(LIST_LENGTH)
    ]
    listed = _ranked_names(ranked, texts.pair_text(F.col(name), F.col("avg_delay")))
    return listed.select(F.col("origin").alias("airport"), *cells)


def mean_arrival_delay(flights: DataFrame) -> DataFrame:
    """Mean arrival delay per origin and destination."""
    return mean_by(flights, ["origin", "dest"], "arr_delay", "mean_delay").select(
        "origin", F.col("dest").alias("destination"), "mean_delay"
    )
