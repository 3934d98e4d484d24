"""File writers. All replace what was at the path before."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyledger.functions import clock
from skyledger.sources.records import flight_lines


def write_flights_tsv(flights: DataFrame, path: str) -> None:
    flight_lines(flights).write.mode("overwrite").text(path)


def write_coupons_tsv(coupons: DataFrame, path: str) -> None:
    (
        coupons.select("year", "origin", "dest").write.mode("overwrite")
        .option("sep", "\t").option("quote", "").option("emptyValue", "").csv(path)
    )


def write_flights(flights: DataFrame, path: str) -> None:
    """Cleaned flights as Parquet by year, so one year is a folder and not a copy.

    The rebalance keeps a year in few files however its rows were spread, and
    splits a year that holds most rows.
    """
    (
        flights.hint("rebalance", "year").write.mode("overwrite")
        .partitionBy("year").parquet(path)
    )


def write_csv(rows: DataFrame, path: str, header: bool = False) -> None:
    """Plain CSV; zone-less timestamps get the ISO form `...T07:10:00.000Z`."""
    (
        rows.write.mode("overwrite").option("header", header).option("lineSep", "\n")
        .option("escape", '"').option("emptyValue", "")
        .option("timestampNTZFormat", clock.ISO_MILLIS).csv(path)
    )


def write_single_csv(rows: DataFrame, path: str, header: bool = False) -> None:
    """One CSV file, for results whose size is small by meaning (a report).

    The rows pass through one writer task only at the very end: the repartition
    keeps the work before it as parallel as it was.
    """
    write_csv(rows.repartition(1), path, header)


def write_quoted_csv(rows: DataFrame, path: str) -> None:
    """CSV with every field in double quotes."""
    rows.write.mode("overwrite").option("quoteAll", True).csv(path)
