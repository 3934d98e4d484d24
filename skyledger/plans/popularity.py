"""Which airports carry the most flights, and how popularity is distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from skyledger.operators.ranking import number_by_total
from skyledger.operators.traffic import airport_totals


def busiest(totals: DataFrame, n: int = 10) -> DataFrame:
    """The `n` airports with the largest totals, unknown totals last.

    Sort and limit run as one top-n per task; only the `n` winners are numbered.
    """
    order = [F.col("total").desc_nulls_last(), F.col("airport").asc_nulls_last()]
    winners = totals.orderBy(*order).limit(n)
    return winners.select(
        F.row_number().over(Window.orderBy(*order)).alias("place"), "airport", "total"
    )


def top_airports(records: DataFrame, n: int = 10) -> DataFrame:
    return busiest(airport_totals(records), n)


# Decimal places of the log-log columns; enough for a chart, and the same on any platform.
LOG_PLACES = 9


def popularity_rank(records: DataFrame) -> DataFrame:
    """Rank and total of every airport with a known total, with log-log columns."""
    numbered = number_by_total(airport_totals(records))
    return numbered.select(
        "rank",
        "total",
        F.round(F.log10("rank"), LOG_PLACES).alias("log10_rank"),
        F.round(F.log10("total"), LOG_PLACES).alias("log10_total"),
    )
