"""Raw exports to cleaned flights and coupons."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import clock

# Years up to this one, and clock readings from this one, are unusable.
LAST_BAD_YEAR = 1980
CLOCK_LIMIT = 2400


def clean_on_time(
    raw: DataFrame, year: int | None = None, valid_clock_only: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """Ten typed columns from the on-time export.

    Header rows have no numeric year and fall out with the year filter. A missing
    delay counts as zero. An impossible clock reading below 2400 (1965) keeps its row
    with a null departure moment, unless `valid_clock_only` drops it. Columns named in
    `keep` are passed on.
    """
    year_number = F.col("Year").try_cast("int")
    kept = raw.where(
        (year_number > LAST_BAD_YEAR) & (clock.clock_number(F.col("CRSDepTime")) < CLOCK_LIMIT)
    )
    if year is not None:
        kept = kept.where(year_number == year)
    if valid_clock_only:
        kept = kept.where(clock.clock_number(F.col("CRSDepTime")) % 100 < 60)
    return kept.select(
        year_number.alias("year"),
        clock.parse_date(F.col("FlightDate")).alias("flight_date"),
        clock.departure_datetime(
            clock.parse_date(F.col("FlightDate")), F.col("CRSDepTime")
        ).alias("flight_datetime"),
        F.col("DayOfWeek").alias("day_of_week"),
        F.col("UniqueCarrier").alias("carrier"),
        F.col("FlightNum").alias("flight_num"),
        F.col("Origin").alias("origin"),
        F.col("Dest").alias("dest"),
        F.coalesce(F.col("DepDelay").try_cast("double"), F.lit(0.0)).alias("dep_delay"),
        F.coalesce(F.col("ArrDelay").try_cast("double"), F.lit(0.0)).alias("arr_delay"),
        *(keep or []),
    )


def clean_origin_destination(raw: DataFrame) -> DataFrame:
    """Year, origin and destination from the coupon export."""
    year_number = F.col("Year").try_cast("int")
    return raw.where(year_number > LAST_BAD_YEAR).select(
        year_number.alias("year"), F.col("Origin").alias("origin"), F.col("Dest").alias("dest")
    )
