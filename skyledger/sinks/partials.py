"""Sums and counts by key that add up: what a backfill summed, and what a stream adds batch by batch.

Every part of the records is summed by whoever reads it: a batch job over the past, a stream over
what comes. Each keeps its own sums below one path, and an answer adds those of all parts. A
stream needs no state for this, as a batch adds only what it holds, once, however often it is
replayed; a backfill that is done again takes the place of its earlier sums. Which records belong to
which part is the caller's to say, such as by a moment that parts the past from the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.session import hadoop_path
from skyledger.sinks.snapshots import Snapshots, Table

SUMS = ("n", "total")


def sum_by(records: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Number of known values and their sum per key; a key whose values are all null has n = 0."""
    return records.groupBy(*keys).agg(
        F.count(value).alias("n"), F.sum(F.col(value).cast("double")).alias("total")
    )


def mean_of(partials: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The mean per key of rows that `sum_by` made, from however many parts."""
    added = partials.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS])
    return added.select(*keys, F.try_divide("total", "n").alias(name))


class PartialSums:
    def __init__(self, path: str, keys: T.StructType):
        self.path = path
        self.keys = keys.fieldNames()
        self.schema = T.StructType([
            *keys.fields, T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType()),
        ])

    def part(self, name: str) -> Snapshots:
        return Snapshots(f"{self.path}/part={name}", {"sums": Table(self.schema, tuple(self.keys), adds=SUMS)})

    def parts(self, spark: SparkSession) -> list[str]:
        files, root = hadoop_path(spark, self.path)
        if not files.exists(root):
            return []
        names = [e.getPath().getName() for e in files.listStatus(root)]
        return sorted(n.removeprefix("part=") for n in names if n.startswith("part="))

    def backfill(self, name: str, records: DataFrame, value: str) -> None:
        """Sum records as the part `name`, in place of what that part held."""
        spark, part = records.sparkSession, self.part(name)
        part.replace(spark, part.open(spark).batch + 1, {"sums": sum_by(records, self.keys, value)})
        part.forget(spark)

    def add(self, name: str, records: DataFrame, value: str, batch_id: int, fold_every: int) -> None:
        """Add a stream's batch to the part `name`; a replay takes the place of the first attempt."""
        spark, part = records.sparkSession, self.part(name)
        part.publish(spark, batch_id, {"sums": part.write(sum_by(records, self.keys, value), "sums", batch_id)})
        part.fold(spark, batch_id, fold_every)

    def sums(self, spark: SparkSession) -> DataFrame:
        """Count and sum per key and part, each part as of its newest batch."""
        rows = spark.createDataFrame([], self.schema)
        for name in self.parts(spark):
            rows = rows.unionByName(self.part(name).latest(spark, "sums").drop("batch_id"))
        return rows

    def means(self, spark: SparkSession, name: str) -> DataFrame:
        return mean_of(self.sums(spark), self.keys, name)
