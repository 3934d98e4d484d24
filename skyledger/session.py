"""Session settings and the shared folder used for staged tables."""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the pipelines expect; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, else one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/staged").rstrip("/")


_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged within the block when it is left, also by an error.

    A result that reads them has to be written inside:

        with scratch(spark):
            corpus.write.parquet(out)

    A block inside another removes its own. Other threads' tables, such as those of a running
    stream, stay.
    """
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get()
        _made.reset(token)
        for path in made:
            files, folder = hadoop_path(spark, path)
            files.delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives lost executors, and lets several
    consumers share one computation.
    """
    path = new_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """The file system a path lies in, and the path as that takes it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number of files below a folder and their bytes, without listing them here."""
    files, folder = hadoop_path(spark, path)
    summary = files.getContentSummary(folder)
    return summary.getFileCount(), summary.getLength()


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful streams; the caller's settings stay as they are.

    State partitions are fixed when a query first starts: `spark.sql.shuffle.partitions`,
    or `state_partitions`, as small trial runs may choose few. RocksDB keeps state off the
    heap, and changelog checkpoints write only what a batch changed.
    """
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    if state_partitions:
        sibling.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    sibling.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    sibling.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )
    return sibling
