"""Keyed result tables: the last write per key wins.

Each batch is an immutable folder `batch_id=N`, written whole. Writing it again
after a failure replaces the same folder, so replays change nothing, and a batch
costs only what it changed; no earlier file is touched. Reading takes the newest
row per key. `compact` folds the batches so far into one base, after which readers
skip the folded ones; `forget_folded` removes those, and bases older than the newest.

No folder is written while it is read, and nothing is deleted before what replaces it is
finished. `replace` starts a new generation, a folder of its own that counts once its
marker exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyledger.schemas import extended

# Marks a generation whose rows are complete.
READY = "_READY"
# Batches between two folds of a stream's table.
FOLD_EVERY = 100


class KeyedTable:
    def __init__(self, path: str, schema: T.StructType, keys: list[str], sort_by: str | None = None):
        self.path = path
        self.schema = schema
        self.keys = keys
        self.sort_by = sort_by
        self._stored = extended(schema, "batch_id", T.LongType())

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Store rows (one per key) as batch `batch_id`."""
        rows = rows.select(*self.schema.fieldNames())
        if self.sort_by:
            rows = rows.sortWithinPartitions(self.sort_by)
        rows.write.mode("overwrite").parquet(f"{self.root(rows.sparkSession)}/changes/batch_id={batch_id}")

    def replace(self, rows: DataFrame) -> None:
        """Load `rows` in place of everything; they come before any later batch.

        Readers see the old rows until the new ones are complete.
        """
        spark = rows.sparkSession
        old = self._generation(spark)
        root = f"{self.path}/generation={old + 1}"
        rows = rows.select(*self.schema.fieldNames(), F.lit(-1).cast("bigint").alias("batch_id"))
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy("batch_id").parquet(f"{root}/changes")
        )
        files, marker = self._at(spark, f"{root}/{READY}")
        files.create(marker, True).close()
        for part in [f"{self.path}/changes", f"{self.path}/base"] if not old else [f"{self.path}/generation={old}"]:
            files.delete(self._at(spark, part)[1], True)

    def changes(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What batch `batch_id` wrote."""
        return spark.read.schema(self.schema).parquet(f"{self.root(spark)}/changes/batch_id={batch_id}")

    def latest(
        self, spark: SparkSession, upto: int | None = None, where: Column | None = None
    ) -> DataFrame:
        """The newest row per key, plus the `batch_id` that wrote it.

        `where` may use key columns only; it is applied before the newest row is
        chosen, so it reaches the Parquet scan.
        """
        base_id = self._base_id(spark, upto)
        stored = self._read(spark, "changes")
        if base_id is not None:
            stored = stored.where(F.col("batch_id") > base_id)
        if upto is not None:
            stored = stored.where(F.col("batch_id") <= upto)
        if base_id is not None:
            stored = stored.unionByName(
                spark.read.schema(self._stored).parquet(f"{self.root(spark)}/base/upto={base_id}")
            )
        if where is not None:
            stored = stored.where(where)
        values = [c for c in self.schema.fieldNames() if c not in self.keys]
        newest = F.max(F.struct("batch_id", *values)).alias("newest")
        return (
            stored.groupBy(*self.keys).agg(newest)
            .select(*self.keys, "newest.*")
            .select(*self.schema.fieldNames(), "batch_id")
        )

    def lookup(self, spark: SparkSession, **key) -> DataFrame:
        """Rows whose key columns equal the given values."""
        condition = F.lit(True)
        for column, value in key.items():
            condition = condition & (F.col(column) == F.lit(value))
        return self.latest(spark, where=condition).drop("batch_id")

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold batches up to `upto` into one base, sorted for pruning.

        A finished base stays as it is, so a repeated fold neither reads nor writes.
        """
        if self._base_id(spark, upto) == upto:
            return
        rows = self.latest(spark, upto=upto)
        if self.sort_by:
            rows = rows.hint("rebalance", self.sort_by).sortWithinPartitions(self.sort_by)
        rows.write.mode("overwrite").parquet(f"{self.root(spark)}/base/upto={upto}")

    def forget_folded(self, spark: SparkSession, upto: int | None = None) -> None:
        """Remove what the newest finished base (not beyond `upto`) already holds."""
        base_id = self._base_id(spark, upto)
        if base_id is None:
            return
        for part, last in (("changes", base_id), ("base", base_id - 1)):
            files, root = self._folder(spark, part)
            if not files.exists(root):
                continue
            for entry in files.listStatus(root):
                number = entry.getPath().getName().partition("=")[2]
                if number.lstrip("-").isdigit() and int(number) <= last:
                    files.delete(entry.getPath(), True)

    def fold(self, spark: SparkSession, batch_id: int, every: int) -> None:
        """Every `every` batches: drop what an earlier batch folded, then fold the batches so far.

        A batch's own changes and those since the fold before stay until the next fold, so
        a batch that is replayed after a failure finds all it read the first time.
        """
        if batch_id and batch_id % every == 0:
            self.forget_folded(spark, batch_id - 1)
            self.compact(spark, batch_id)

    def root(self, spark: SparkSession) -> str:
        """Where the current generation's batches lie."""
        number = self._generation(spark)
        return f"{self.path}/generation={number}" if number else self.path

    def _generation(self, spark: SparkSession) -> int:
        """The newest finished generation; 0 is the table before any `replace`."""
        files, path = self._at(spark, self.path)
        if not files.exists(path):
            return 0
        names = [e.getPath() for e in files.listStatus(path) if e.getPath().getName().startswith("generation=")]
        return max([int(n.getName().split("=")[1]) for n in names if files.exists(n.suffix(f"/{READY}"))], default=0)

    def _at(self, spark: SparkSession, path: str):
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(spark._jsc.hadoopConfiguration()), found

    def _folder(self, spark: SparkSession, part: str):
        return self._at(spark, f"{self.root(spark)}/{part}")

    def _read(self, spark: SparkSession, part: str) -> DataFrame:
        files, root = self._folder(spark, part)
        if not files.exists(root):
            return spark.createDataFrame([], self._stored)
        return spark.read.schema(self._stored).parquet(f"{self.root(spark)}/{part}")

    def _base_id(self, spark: SparkSession, upto: int | None) -> int | None:
        """The newest finished base not beyond `upto`; unfinished ones are ignored."""
        files, root = self._folder(spark, "base")
        if not files.exists(root):
            return None
        finished = [
            int(entry.getPath().getName().split("=")[1])
            for entry in files.listStatus(root)
            if files.exists(entry.getPath().suffix("/_SUCCESS"))
        ]
        fitting = [b for b in finished if upto is None or b <= upto]
        return max(fitting, default=None)
