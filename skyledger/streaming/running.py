"""Running counts and means over a record stream.

State is what Spark's own aggregates keep: a count, or a sum and a count. It never
expires, as every airport, weekday and route stays in the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.functions import texts
from skyledger.operators.averages import mean_by
from skyledger.operators.ranking import number_by_total
from skyledger.operators.traffic import endpoint_counts
from skyledger.plans.popularity import busiest
from skyledger.plans.punctuality import as_wide_list, mean_arrival_delay, ten_best
from skyledger.sinks.files import write_quoted_csv
from skyledger.sinks.keyed import FOLD_EVERY, KeyedTable
from skyledger.sinks.partials import PartialSums
from skyledger.sources.records import flights_from_lines
from skyledger.streaming.runs import BATCH_SECONDS, each_batch


def _batch_files(out: str, batch_id: int) -> str:
    return f"{out}/batch={batch_id}"


def top_airports(
    topic: DataFrame, out: str, checkpoint: str, n: int = 10, seconds: int | None = BATCH_SECONDS
) -> StreamingQuery:
    """After every batch, the `n` airports touched by most flights, as quoted CSV."""

    def handle(counts: DataFrame, batch_id: int) -> None:
        write_quoted_csv(busiest(counts, n), _batch_files(out, batch_id))

    counts = endpoint_counts(flights_from_lines(topic))
    return each_batch(counts, handle, checkpoint, "complete", seconds)


def popularity_index(
    topic: DataFrame, out: str, checkpoint: str, seconds: int | None = BATCH_SECONDS
) -> StreamingQuery:
    """After every batch, airport totals numbered from 0, largest first, as quoted CSV."""

    def handle(counts: DataFrame, batch_id: int) -> None:
        numbered = number_by_total(counts).select(F.col("position").alias("index"), "total")
        write_quoted_csv(numbered, _batch_files(out, batch_id))

    counts = endpoint_counts(flights_from_lines(topic))
    return each_batch(counts, handle, checkpoint, "complete", seconds)


def weekday_delay(
    topic: DataFrame, out: str, checkpoint: str, seconds: int | None = BATCH_SECONDS
) -> StreamingQuery:
    """After every batch, weekdays by mean arrival delay, best first, as quoted CSV."""
    means = (
        mean_by(flights_from_lines(topic), ["day_of_week"], "arr_delay", "avg_delay")
        .withColumn("day_name", texts.weekday_name(F.col("day_of_week")))
        .select("day_of_week", "day_name", "avg_delay")
        .orderBy("avg_delay", "day_of_week")
    )

    def handle(days: DataFrame, batch_id: int) -> None:
        write_quoted_csv(days, _batch_files(out, batch_id))

    return each_batch(means, handle, checkpoint, "complete", seconds)


def mean_arrival_table(
    topic: DataFrame, table: KeyedTable, checkpoint: str, seconds: int | None = BATCH_SECONDS,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Keeps the mean arrival delay per route in a keyed table; a batch writes changed routes only."""
    means = mean_arrival_delay(flights_from_lines(topic))

    def handle(changed: DataFrame, batch_id: int) -> None:
        table.upsert(changed, batch_id)
        table.fold(changed.sparkSession, batch_id, fold_every)

    return each_batch(means, handle, checkpoint, "update", seconds)


def partial_arrival_delays(
    topic: DataFrame, sums: PartialSums, part: str, checkpoint: str, seconds: int | None = BATCH_SECONDS,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Adds the arrival delays per route of each batch to `sums`, as one of its parts.

    Keeps no state: `mean_arrival_table` holds all sums in the stream, where no backfill can
    add to them. `sums.means` answers over all parts.
    """
    flights = flights_from_lines(topic).withColumnRenamed("dest", "destination")

    def handle(batch: DataFrame, batch_id: int) -> None:
        sums.add(part, batch, "arr_delay", batch_id, fold_every)

    return each_batch(flights, handle, checkpoint, "append", seconds)


def _store_changed(table: KeyedTable, rows: DataFrame, batch_id: int, fold_every: int) -> None:
    """Upsert the rows that differ from what earlier batches stored."""
    spark = rows.sparkSession
    if batch_id > 0:
        known = table.latest(spark, upto=batch_id - 1)
        same = [rows[c].eqNullSafe(known[c]) for c in table.schema.fieldNames()]
        rows = rows.join(known, same, "left_anti")
    table.upsert(rows, batch_id)
    table.fold(spark, batch_id, fold_every)


def ten_best_table(
    topic: DataFrame, name: str, ranked: KeyedTable, wide: KeyedTable | None, prefix: str,
    checkpoint: str, seconds: int | None = BATCH_SECONDS, fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Keeps the ten best `name`s (`carrier` or `dest`) per origin by mean departure delay.

    `ranked` gets one row per (origin, rank), `wide` one row per airport with ten
    cells; a batch writes the rows it changes. The means of all names are needed to
    choose ten, hence complete mode; the state is one row per (origin, name).
    """

    def handle(means: DataFrame, batch_id: int) -> None:
        means = means.persist()
        try:
            best = ten_best(means, name)
            _store_changed(ranked, best, batch_id, fold_every)
            if wide is not None:
                _store_changed(wide, as_wide_list(best, name, prefix), batch_id, fold_every)
        finally:
            means.unpersist()

    means = mean_by(flights_from_lines(topic), ["origin", name], "dep_delay", "avg_delay")
    return each_batch(means, handle, checkpoint, "complete", seconds)
