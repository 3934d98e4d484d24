"""Best legs and the two-leg trips they combine to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.functions import clock

# Days a traveller stays at the connection airport.
STAY_DAYS = 2


def timed_legs(flights: DataFrame, pm_from_hour: int = 12, keep: list[str] | None = None) -> DataFrame:
    """Flights usable as a leg, under leg names, tagged `am` or `pm`.

    A record without an arrival delay, such as a malformed line, is no leg: it could not
    be ranked against real ones. (Cleaning turns the missing delays of exports into 0.)
    """
    usable = flights.where(clock.outside_noon_gap(F.col("flight_datetime"), pm_from_hour))
    usable = usable.where(F.col("arr_delay").isNotNull())
    return usable.select(
        F.col("arr_delay").alias("arrival_delay"),
        F.col("flight_datetime").alias("date_time"),
        "carrier",
        F.col("flight_num").alias("flight"),
        "origin",
        F.col("dest").alias("destination"),
        F.col("flight_date").alias("date"),
        clock.half_of_day(F.col("flight_datetime")).alias("leg"),
        *[F.col(c) for c in flights.columns if c == "arrival_time" or c in (keep or [])],
    )


def least_delayed() -> Column:
    """Aggregate: the leg with the least arrival delay, as one struct.

    Ties fall to the earliest departure, then carrier, then flight number. The
    group's own columns ride along at the end of the struct.
    """
    return F.min(
        F.struct(
            "arrival_delay", "date_time", "carrier", "flight",
            "origin", "destination", "date", "leg",
        )
    )


def by_leg() -> list[Column]:
    """What legs are grouped by: half-day, route and date, after a number made of them.

    The least delayed leg is a struct, which Spark aggregates by sorting; the number leads, so
    nearly all comparisons of the sort are of one long and not of texts.
    """
    key = ["origin", "destination", "date", "leg"]
    return [F.xxhash64(*key).alias("leg_number"), *map(F.col, key)]


def best_legs(legs: DataFrame) -> DataFrame:
    """The least delayed leg per half-day, route and date.

    All columns come out of the aggregate itself, so no later filter on them can
    move below it: both sides of the trip join keep the same subplan and Spark
    runs the scan and the shuffle once (ReusedExchange).
    """
    return (
        legs.groupBy(*by_leg())
        .agg(least_delayed().alias("best"))
        .select("best.*")
    )


def with_meeting(legs: DataFrame) -> DataFrame:
    """Legs with the airport (`hub`) and the date (`meet`) at which they meet others for a trip."""
    am = F.col("leg") == "am"
    return legs.withColumns({
        "hub": F.when(am, F.col("destination")).otherwise(F.col("origin")),
        "meet": F.when(am, F.date_add(F.col("date"), STAY_DAYS)).otherwise(F.col("date")),
    })


def pair_legs(am: DataFrame, pm: DataFrame, also_on: list[str] | None = None, meeting: bool = False) -> DataFrame:
    """Trips X -> Y -> Z: `am` reaches Y, `pm` leaves Y `STAY_DAYS` days later.

    The day gap is part of the equi key, so both sides shuffle on (airport, date)
    and a hub airport spreads over its dates. No broadcast is forced: the legs grow
    with the data and Spark checks their size itself. `meeting` joins on the columns of
    `with_meeting`, which stored legs are laid out by.
    """
    extra = also_on or []
    a, p = am.alias("a"), pm.alias("p")
    condition = (F.col("a.destination") == F.col("p.origin")) & (
        F.date_add(F.col("a.date"), STAY_DAYS) == F.col("p.date")
    )
    if meeting:
        condition = (F.col("a.hub") == F.col("p.hub")) & (F.col("a.meet") == F.col("p.meet"))
    for column in extra:
        condition = condition & (F.col(f"a.{column}") == F.col(f"p.{column}"))
    return a.join(p, condition).select(
        F.col("a.date").alias("origin_date"),
        F.col("a.date_time").alias("origin_date_time"),
        F.col("a.carrier").alias("origin_carrier"),
        F.col("a.flight").alias("origin_flight"),
        F.col("a.origin").alias("origin"),
        F.col("a.destination").alias("connection"),
        F.col("a.arrival_delay").alias("connection_arr_delay"),
        F.col("p.date").alias("connection_date"),
        F.col("p.date_time").alias("connection_date_time"),
        F.col("p.carrier").alias("connection_carrier"),
        F.col("p.flight").alias("connection_flight"),
        F.col("p.destination").alias("destination"),
        F.col("p.arrival_delay").alias("destination_arr_delay"),
        *[F.col(f"a.{c}").alias(c) for c in extra],
    )


def only_leg(legs: DataFrame, leg: str) -> DataFrame:
    return legs.where(F.col("leg") == leg)
