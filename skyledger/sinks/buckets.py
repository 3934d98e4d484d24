"""Folders of rows laid out in buckets, so that grouping or joining on the bucket columns moves nothing.

All folders of one path belong to one external catalog table: each is a partition of it, written
once under a name of its own, and one scan reads any choice of them bucket by bucket. The files
carry the truth; the catalog entry is made where it is missing and brought up to what lies there,
so it may be lost with its session. Rows of another number of buckets lie beside, in a table of their own.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.session import hadoop_path

FOLDER = "folder"


class BucketedFolders:
    """Rows below `path`, in buckets by the columns `by`, sorted by `sort_by` within a file.

    Without `buckets`, there are as many as the session has shuffle partitions, which a join
    needs at least to take a stored side as it lies.
    """

    def __init__(self, path: str, schema: T.StructType, by: tuple[str, ...], sort_by: str | None = None, buckets: int | None = None):
        self.path, self.schema, self.by, self.sort_by, self.buckets = path, schema, by, sort_by, buckets

    def count(self, spark: SparkSession) -> int:
        return self.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def root(self, spark: SparkSession) -> str:
        return f"{self.path}/by{self.count(spark)}"

    def table(self, spark: SparkSession) -> str:
        """The catalog's table over all folders that lie there now."""
        files, root = hadoop_path(spark, self.root(spark))
        files.mkdirs(root)
        full = files.makeQualified(root).toString()
        name = f"skyledger_{hashlib.md5(full.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        listed = ", ".join(self.by)
        ordered = f" SORTED BY ({self.sort_by})" if self.sort_by else ""
        place = full.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {FOLDER} STRING) USING parquet "
            f"PARTITIONED BY ({FOLDER}) CLUSTERED BY ({listed}){ordered} INTO {self.count(spark)} BUCKETS LOCATION '{place}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        return name

    def write(self, rows: DataFrame, folder: str) -> str:
        """Store rows as a folder that is not there yet; returns its path below `path`.

        Rows that come bucket by bucket already, as those of `read` do, are not shuffled.
        """
        spark = rows.sparkSession
        name, n = self.table(spark), self.count(spark)
        rows = rows.select(*self.schema.fieldNames()).repartition(n, *self.by)
        rows.withColumn(FOLDER, F.lit(folder)).write.mode("append").insertInto(name)
        return f"by{n}/{FOLDER}={folder}"

    def read(self, spark: SparkSession, written: list[str]) -> DataFrame:
        """The rows of folders that `write` named; by buckets, unless some have another number of them."""
        kept = f"by{self.count(spark)}/{FOLDER}="
        if written and all(w.startswith(kept) for w in written):
            names = [w.removeprefix(kept) for w in written]
            return spark.table(self.table(spark)).where(F.col(FOLDER).isin(names)).drop(FOLDER)
        return self.read_files(spark, written)

    def read_files(self, spark: SparkSession, written: list[str]) -> DataFrame:
        """The same without the catalog, for readers that have no use for buckets."""
        found = [f"{self.path}/{w}" for w in written]
        # Rows that were none left no folder.
        found = [p for p in found if (at := hadoop_path(spark, p))[0].exists(at[1])]
        if not found:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*found)

    def folders(self, spark: SparkSession) -> list[str]:
        """All that lies there, of any number of buckets."""
        files, top = hadoop_path(spark, self.path)
        if not files.exists(top):
            return []
        return [
            f"{kind.getPath().getName()}/{entry.getPath().getName()}"
            for kind in files.listStatus(top) if kind.getPath().getName().startswith("by")
            for entry in files.listStatus(kind.getPath()) if entry.getPath().getName().startswith(f"{FOLDER}=")
        ]

    def remove(self, spark: SparkSession, written: list[str]) -> None:
        for name in written:
            files, path = hadoop_path(spark, f"{self.path}/{name}")
            files.delete(path, True)
