"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the on-time performance export (55 columns).
ON_TIME_COLUMNS = [
    "Year", "Quarter", "Month", "DayOfMonth", "DayOfWeek", "FlightDate",
    "UniqueCarrier", "AirlineID", "Carrier", "TailNum", "FlightNum",
    "Origin", "OriginCityName", "OriginState", "OriginStateFips",
    "OriginStateName", "OriginWac",
    "Dest", "DestCityName", "DestState", "DestStateFips", "DestStateName",
    "DestWac",
    "CRSDepTime", "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15",
    "DepartureDelayGroups", "DepTimeBlk", "TaxiOut", "WheelsOff", "WheelsOn",
    "TaxiIn", "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes",
    "ArrDel15", "ArrivalDelayGroups", "ArrTimeBlk",
    "Cancelled", "CancellationCode", "Diverted", "CRSElapsedTime",
    "ActualElapsedTime", "AirTime", "Flights", "Distance", "DistanceGroup",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
    "LateAircraftDelay",
]

# Column order of the origin/destination coupon export (34 columns).
COUPON_COLUMNS = [
    "ItinID", "MktID", "SeqNum", "Coupons", "Year", "Quarter",
    "Origin", "OriginAptInd", "OriginCityNum", "OriginCountry",
    "OriginStateFips", "OriginState", "OriginStateName", "OriginWac",
    "Dest", "DestAptInd", "DestCityNum", "DestCountry", "DestStateFips",
    "DestState", "DestStateName", "DestWac",
    "Break", "CouponType", "TkCarrier", "OpCarrier", "RPCarrier",
    "Passengers", "FareClass", "Distance", "DistanceGroup", "Gateway",
    "ItinGeoType", "CouponGeoType",
]

# The columns of the exports that are not plain text.
RAW_TYPES = {
    "Year": T.IntegerType(),
    "DayOfMonth": T.IntegerType(),
    "DepDelay": T.DoubleType(),
    "ArrDelay": T.DoubleType(),
}


def _raw(columns: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(c, RAW_TYPES.get(c, T.StringType())) for c in columns]
    )


RAW_ON_TIME = _raw(ON_TIME_COLUMNS)
RAW_COUPONS = _raw(COUPON_COLUMNS)

# A departure time is a wall-clock reading at the origin airport, so it is held
# without a zone and does not move with the session time zone.
FLIGHTS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("flight_date", T.DateType()),
        T.StructField("flight_datetime", T.TimestampNTZType()),
        T.StructField("day_of_week", T.StringType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("flight_num", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("dest", T.StringType()),
        T.StructField("dep_delay", T.DoubleType()),
        T.StructField("arr_delay", T.DoubleType()),
    ]
)

COUPONS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("origin", T.StringType()),
        T.StructField("dest", T.StringType()),
    ]
)

# One stored leg: the best flight of a route on a date, in the first half of
# the day ("am") or the second ("pm").
LEGS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("date_time", T.TimestampNTZType()),
        T.StructField("carrier", T.StringType()),
        T.StructField("flight", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("arrival_delay", T.DoubleType()),
        T.StructField("leg", T.StringType()),
    ]
)
LEG_KEY = ["leg", "date", "origin", "destination"]

# Stored legs lie by the airport and the date at which they meet others for a trip.
MEETING = ["hub", "meet"]
STORED_LEGS = T.StructType([*LEGS.fields, T.StructField("hub", T.StringType()), T.StructField("meet", T.DateType())])

TRIPS = T.StructType(
    [
        T.StructField("origin_date", T.DateType()),
        T.StructField("origin_date_time", T.TimestampNTZType()),
        T.StructField("origin_carrier", T.StringType()),
        T.StructField("origin_flight", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("connection", T.StringType()),
        T.StructField("connection_arr_delay", T.DoubleType()),
        T.StructField("connection_date", T.DateType()),
        T.StructField("connection_date_time", T.TimestampNTZType()),
        T.StructField("connection_carrier", T.StringType()),
        T.StructField("connection_flight", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("destination_arr_delay", T.DoubleType()),
    ]
)
TRIP_KEY = ["origin", "connection", "destination", "origin_date"]

# Stored trips carry one number for their route, by which files are sorted and looked up.
STORED_TRIPS = T.StructType([*TRIPS.fields, T.StructField("route_key", T.LongType())])

MEAN_DELAYS = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("mean_delay", T.DoubleType()),
    ]
)


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns, all read as text (converted by a later select)."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def extended(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    """A copy with one more column (`StructType.add` would change the original)."""
    return T.StructType([*schema.fields, T.StructField(name, kind)])
