"""Ranks, numberings and per-group top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from skyledger.session import stage

# Rows one generated array may hold when a run of equal totals is written out.
RUN_BLOCK = 1024
# Distinct totals one task numbers.
RANGE_TOTALS = 500_000


def first_per_group(rows: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """The first `n` rows of each group with their `rank`.

    Spark limits each group on the map side too (WindowGroupLimit), so a task
    sends at most `n` rows per group however large the group is.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def number_by_total(totals: DataFrame, range_totals: int = RANGE_TOTALS) -> DataFrame:
    """Rows (`position`, `rank`, `total`), largest total first.

    `position` counts 0, 1, 2, ... without gaps; `rank` starts at 1 and equal
    totals share it, leaving gaps. One row per input row; null totals are dropped.

    No task sees all rows, nor all totals: rows are first reduced to one per distinct total,
    and these are laid out in ranges of about `range_totals`. A range adds up its own; one
    number per range, the rows before it, makes that global. Equal rows are then
    written out again in blocks of bounded size, spread over tasks before they grow, so a
    total that most rows share is no hot spot.
    """
    runs = stage(
        totals.where(F.col("total").isNotNull()).groupBy("total").agg(F.count(F.lit(1)).alias("run")), "totals")
    ranges = max(1, -(-runs.count() // range_totals))
    # written, so that every reader sees the same ranges
    ranged = stage(
        runs.repartitionByRange(ranges, F.col("total").desc()).withColumn("range", F.spark_partition_id()), "ranges")
    ahead, sizes = {}, ranged.groupBy("range").agg(F.sum("run").alias("n"))
    before = 0
    for row in sizes.orderBy("range").toLocalIterator():  # a row per range
        ahead[row["range"]], before = before, before + row["n"]
    spark = totals.sparkSession
    offsets = spark.createDataFrame(list(ahead.items()), "range int, ahead bigint")
    inside = Window.partitionBy("range").orderBy(F.col("total").desc()).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.withColumn("inside", F.coalesce(F.sum("run").over(inside), F.lit(0))).join(offsets, "range").select(
        "total", "run", (F.col("ahead") + F.col("inside")).alias("start"))
    blocks = starts.withColumn(
        "block", F.explode(F.expr(f"sequence(0L, (run - 1) div {RUN_BLOCK})"))
    ).repartition("start", "block")
    offset = F.explode(
        F.expr(
            f"sequence(block * {RUN_BLOCK}, least((block + 1) * {RUN_BLOCK}, run) - 1)"
        )
    )
    return blocks.withColumn("offset", offset).select(
        (F.col("start") + F.col("offset")).alias("position"),
        (F.col("start") + 1).alias("rank"),
        "total",
    )
