"""Flight records derived from `lineitem` and `orders`.

The real exports are not part of the test data, so each order line stands for one
flight. Spark and the check SQL use the same expressions; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_DATE = (
    "date_add(make_date(CAST(2007 + l_linenumber % 2 AS INT), 1, 1), CAST(l_partkey % 40 AS INT))"
)

# Raw column -> expression.
_RAW = {
    "Year": "CAST(2007 + l_linenumber % 2 AS INT)",
    "DayOfWeek": f"CAST(extract(DAYOFWEEK_ISO FROM {_DATE}) AS STRING)",
    "FlightDate": _DATE,
    "UniqueCarrier": "'C' || lpad(CAST((l_partkey + l_suppkey) % 20 AS STRING), 2, '0')",
    "FlightNum": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
    "Origin": "'A' || lpad(CAST(l_suppkey % 40 AS STRING), 2, '0')",
    "Dest": "'A' || lpad(CAST(3 + o_custkey % 42 AS STRING), 2, '0')",
    "CRSDepTime": (
        "CASE WHEN l_linenumber = 6 AND l_orderkey % 50 = 0 THEN '2400' ELSE "
        "lpad(CAST((l_orderkey * 7 + l_linenumber * 5) % 24 AS STRING), 2, '0') || "
        "lpad(CAST((l_partkey % 12) * 5 AS STRING), 2, '0') END"
    ),
    "DepDelay": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(l_quantity AS INT) - 15 AS DOUBLE) END",
    "ArrDelay": (
        "CASE WHEN l_linenumber = 7 THEN NULL ELSE "
        "CAST(CAST(l_quantity AS INT) - 20 + CAST(l_orderkey % 9 AS INT) AS DOUBLE) END"
    ),
}

# Second of arrival within two minutes from 2024-01-01T00:00:00Z, for streams.
ARRIVAL_START = 1704067200
ARRIVAL_SPAN = 120
_ARRIVAL = f"timestamp_seconds({ARRIVAL_START} + CAST(l_orderkey % {ARRIVAL_SPAN} AS INT)) AS timestamp"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_flights(spark: SparkSession, sf_dir: str, with_arrival: bool = False) -> DataFrame:
    """Raw flight records, all order lines; only columns used later are computed."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    columns = [f"{expression} AS {name}" for name, expression in _RAW.items()]
    if with_arrival:
        columns.append(_ARRIVAL)
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(*columns)


def with_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with some years spoilt (1980, null) and some readings impossible (1965), by arrival second."""
    raw = raw_flights(spark, sf_dir, with_arrival=True)
    second = F.unix_seconds("timestamp") - ARRIVAL_START
    return (
        raw.withColumn("Year", F.when(second == 7, 1980).when(second != 11, F.col("Year")))
        .withColumn("CRSDepTime", F.when(second == 13, "1965").otherwise(F.col("CRSDepTime")))
        .drop("timestamp")
    )
