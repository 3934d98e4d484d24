"""Tab-separated records to typed columns, for files and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schemas
from skyledger.functions import clock, texts


def _flight_columns(field) -> list[Column]:
    readers = {
        "year": lambda c: c.try_cast("int"),
        "flight_date": clock.parse_date,
        "flight_datetime": clock.parse_iso_datetime,
        "dep_delay": lambda c: c.try_cast("double"),
        "arr_delay": lambda c: c.try_cast("double"),
    }
    return [
        readers.get(name, lambda c: c)(field(name)).alias(name)
        for name in schemas.FLIGHTS.fieldNames()
    ]


def typed_flights(text_columns: DataFrame) -> DataFrame:
    return text_columns.select(*_flight_columns(F.col))


def typed_coupons(text_columns: DataFrame) -> DataFrame:
    return text_columns.select(F.col("year").try_cast("int").alias("year"), "origin", "dest")


def flights_from_lines(lines: DataFrame, line: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Ten-field lines to typed flights; malformed fields become null, `keep` columns stay.

    A line is split once. Its fields come out of a generator of one row, which filters on
    fields do not pass; below it they would split the line again for each mention of a field.
    """
    order = schemas.FLIGHTS.fieldNames()
    cells = lines.select(F.explode(F.array(texts.tab_fields(F.col(line)))).alias("cells"), *(keep or []))

    def field(name: str) -> Column:
        text = F.get("cells", F.lit(order.index(name)))
        return F.when(text != "", text)

    return cells.select(*_flight_columns(field), *(keep or []))


def flight_lines(flights: DataFrame, name: str = "value", keep: list[str] | None = None) -> DataFrame:
    """The inverse: one tab-separated line per flight, nulls as empty fields."""
    cells = [
        F.coalesce(
            clock.iso_datetime(F.col(c), fraction_digits=3)
            if c == "flight_datetime"
            else F.col(c).cast("string"),
            F.lit(""),
        )
        for c in schemas.FLIGHTS.fieldNames()
    ]
    return flights.select(F.concat_ws("\t", *cells).alias(name), *(keep or []))
