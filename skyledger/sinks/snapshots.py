"""Keyed tables that change together: a small versioned file says which folders belong to each.

A batch writes the rows it changes into new folders and then publishes a manifest that
names, table by table, the folders of the whole: a newest base and the changes since. The
manifest appears by one rename, so a reader sees all of a batch or nothing of it, in all
tables alike. No folder is written twice: a replayed batch writes new ones, and the manifest
it publishes names these instead. `fold` writes bases and publishes again; folders go only
when none of the manifests that are kept names them, so a reader that opened a version
before reads on as long as `keep` later versions have not come.

One writer at a time; readers need nothing but the path.
"""

from __future__ import annotations

import dataclasses
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyledger.schemas import extended
from skyledger.session import hadoop_path
from skyledger.sinks.buckets import BucketedFolders

# Versions that stay readable.
KEEP = 20
NUMBER = "{:020d}.json"


@dataclasses.dataclass(frozen=True)
class Table:
    """What a table's rows look like, and which columns are its key.

    With `bucket_by`, some of the key, rows are stored in buckets: finding the newest row of a
    key, and joins on these columns, then need no shuffle of what is stored. With `adds`, rows of
    a key do not follow one another but add up in these columns, which are all but the key.
    """

    schema: T.StructType
    keys: tuple[str, ...]
    sort_by: str | None = None
    bucket_by: tuple[str, ...] = ()
    buckets: int | None = None
    adds: tuple[str, ...] = ()

    @property
    def stored(self) -> T.StructType:
        return extended(self.schema, "batch_id", T.LongType())


@dataclasses.dataclass(frozen=True)
class Version:
    """A published state: `folders` of each table, base first, then changes by batch."""

    number: int
    batch: int
    folders: dict[str, list[str]]

    def name(self, table: str) -> list[str]:
        return self.folders.get(table, [])


class Snapshots:
    def __init__(self, path: str, tables: dict[str, Table], keep: int = KEEP):
        self.path, self.tables, self.keep = path, tables, max(2, keep)

    # --- reading

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the manifests that are there, oldest first."""
        files, root = hadoop_path(spark, f"{self.path}/manifests")
        if not files.exists(root):
            return []
        names = [e.getPath().getName() for e in files.listStatus(root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def load(self, spark: SparkSession, number: int) -> Version:
        files, path = hadoop_path(spark, f"{self.path}/manifests/{NUMBER.format(number)}")
        stream = files.open(path)
        try:
            told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, told["batch"], told["folders"])

    def open(self, spark: SparkSession, before: int | None = None) -> Version:
        """The newest version, or the newest from before batch `before`; without one, an empty state."""
        for number in reversed(self.versions(spark)):
            version = self.load(spark, number)
            if before is None or version.batch < before:
                return version
        return Version(0, -1, {})

    def latest(
        self, spark: SparkSession, table: str, version: Version | None = None, where: Column | None = None,
        by_bucket: bool = False,
    ) -> DataFrame:
        """The newest row per key of a version (the newest, if not given), or the sum, with its `batch_id`.

        `where` may use key columns only; it is applied before the newest row is chosen, so
        it reaches the Parquet scan. A table that is one base alone is read as it is.
        """
        own, version = self.tables[table], version or self.open(spark)
        names = version.name(table)
        if not names:
            return spark.createDataFrame([], own.stored)
        stored = self.rows(spark, table, names, by_bucket)
        if where is not None:
            stored = stored.where(where)
        if len(names) == 1:
            return stored
        if own.adds:
            added = stored.groupBy(*own.keys).agg(*[F.sum(c).alias(c) for c in own.adds], F.max("batch_id").alias("batch_id"))
            return added.select(*own.stored.fieldNames())
        values = [c for c in own.schema.fieldNames() if c not in own.keys]
        newest = stored.groupBy(*own.keys).agg(F.max(F.struct("batch_id", *values)).alias("newest"))
        return newest.select(*own.keys, "newest.*").select(*own.stored.fieldNames())

    def rows(self, spark: SparkSession, table: str, names: list[str], by_bucket: bool = False) -> DataFrame:
        """All rows of folders, with the batches they came with.

        `by_bucket` reads a bucketed table through the catalog, as its writer does.
        """
        own = self.tables[table]
        if not own.bucket_by:
            return spark.read.schema(own.stored).parquet(*[f"{self.path}/{name}" for name in names])
        buckets, below = self._buckets(table), [n.removeprefix(f"{table}/") for n in names]
        return buckets.read(spark, below) if by_bucket else buckets.read_files(spark, below)

    def read(self, spark: SparkSession, folder: str, table: str) -> DataFrame:
        """The rows of one folder that `write` made."""
        return self.rows(spark, table, [folder]).drop("batch_id")

    def _buckets(self, table: str) -> BucketedFolders:
        own = self.tables[table]
        return BucketedFolders(f"{self.path}/{table}", own.stored, own.bucket_by, own.sort_by, own.buckets)

    # --- writing

    def write(self, rows: DataFrame, table: str, batch_id: int) -> str:
        """Store rows (one per key) in a folder of their own; they count once it is published."""
        own = self.tables[table]
        rows = rows.select(*own.schema.fieldNames(), F.lit(batch_id).cast("bigint").alias("batch_id"))
        return self._stored(rows, table, "changes", batch_id)

    def _stored(self, rows: DataFrame, table: str, kind: str, batch_id: int) -> str:
        own = self.tables[table]
        if own.bucket_by:
            return f"{table}/{self._buckets(table).write(rows, f'{kind}-{batch_id}-{uuid.uuid4().hex}')}"
        if own.sort_by:
            rows = rows.sortWithinPartitions(own.sort_by)
        name = f"{table}/{kind}/{batch_id}-{uuid.uuid4().hex}"
        rows.write.mode("error").parquet(f"{self.path}/{name}")
        return name

    def publish(self, spark: SparkSession, batch_id: int, written: dict[str, str]) -> Version:
        """Make a batch's folders part of the tables, all at once.

        They come on top of what was published before this batch, so publishing it again
        replaces what an earlier attempt published.
        """
        before = self.open(spark, before=batch_id)
        folders = {t: [*before.name(t), *([written[t]] if t in written else [])] for t in self.tables}
        return self._publish(spark, batch_id, folders)

    def replace(self, spark: SparkSession, batch_id: int, rows: dict[str, DataFrame]) -> Version:
        """Load tables in place of all they hold; the others stay. Readers see both states whole."""
        now = self.open(spark)
        folders = {t: now.name(t) for t in self.tables}
        for table, new in rows.items():
            new = new.select(*self.tables[table].schema.fieldNames(), F.lit(batch_id).cast("bigint").alias("batch_id"))
            folders[table] = [self._stored(new, table, "base", batch_id)]
        return self._publish(spark, batch_id, folders)

    def fold(self, spark: SparkSession, batch_id: int, every: int) -> None:
        """Every `every` batches: one base for each table of several folders, then let go of old versions."""
        if not batch_id or batch_id % every:
            return
        now = self.open(spark)
        folders = {}
        for table in self.tables:
            folders[table] = now.name(table)
            if len(folders[table]) > 1:
                rows = self.latest(spark, table, now, by_bucket=True)
                if self.tables[table].sort_by and not self.tables[table].bucket_by:
                    rows = rows.hint("rebalance", self.tables[table].sort_by)
                folders[table] = [self._stored(rows, table, "base", now.batch)]
        if folders != now.folders:
            self._publish(spark, now.batch, folders)
        self.forget(spark)

    def forget(self, spark: SparkSession) -> None:
        """Remove manifests beyond the last `keep`, and folders that none of those left names.

        A batch that is replayed needs the state before it, so of the batch before the last
        one version stays too. What is being written is of a batch not yet published, or published
        by an earlier attempt, and stays.
        """
        numbers = self.versions(spark)
        kept = [self.load(spark, n) for n in numbers[-self.keep :]]
        if not kept:
            return
        if all(v.batch == kept[-1].batch for v in kept):
            kept += [v for v in (self.open(spark, before=kept[-1].batch),) if v.number]
        for number in set(numbers) - {v.number for v in kept}:
            files, path = hadoop_path(spark, f"{self.path}/manifests/{NUMBER.format(number)}")
            files.delete(path, False)
        named = {name for v in kept for names in v.folders.values() for name in names}
        for table, own in self.tables.items():
            if own.bucket_by:
                old = [n for n in self._buckets(table).folders(spark)
                       if f"{table}/{n}" not in named and int(n.split("-")[-2]) < kept[-1].batch]
                self._buckets(table).remove(spark, old)
                continue
            for kind in ("changes", "base"):
                files, root = hadoop_path(spark, f"{self.path}/{table}/{kind}")
                if not files.exists(root):
                    continue
                for entry in files.listStatus(root):
                    name = entry.getPath().getName()
                    if f"{table}/{kind}/{name}" not in named and int(name.rpartition("-")[0]) < kept[-1].batch:
                        files.delete(entry.getPath(), True)

    def _publish(self, spark: SparkSession, batch_id: int, folders: dict[str, list[str]]) -> Version:
        number = max(self.versions(spark), default=0) + 1
        files, hidden = hadoop_path(spark, f"{self.path}/manifests/.{uuid.uuid4().hex}")
        _, shown = hadoop_path(spark, f"{self.path}/manifests/{NUMBER.format(number)}")
        out = files.create(hidden, False)
        out.write(bytearray(json.dumps({"batch": batch_id, "folders": folders}).encode()))
        out.close()
        if files.exists(shown) or not files.rename(hidden, shown):
            raise RuntimeError(f"version {number} of {self.path} was published by another writer")
        return Version(number, batch_id, folders)
