"""Starting, pacing and publishing streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from skyledger.functions import texts
from skyledger.session import hadoop_path

# Seconds between micro-batches.
BATCH_SECONDS = 10
WINDOWED_BATCH_SECONDS = 6
PUBLISH_SECONDS = 1

# Records a file of a topic folder holds at most, so that a batch is read by many tasks.
RECORDS_PER_FILE = 100_000

Handler = Callable[[DataFrame, int], None]


def start(writer: DataStreamWriter, checkpoint: str, seconds: int | None = BATCH_SECONDS) -> StreamingQuery:
    """Start with a checkpoint; `seconds=None` works off what is there and ends."""
    writer = writer.option("checkpointLocation", checkpoint)
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def each_batch(
    stream: DataFrame, handler: Handler, checkpoint: str, mode: str, seconds: int | None = BATCH_SECONDS
) -> StreamingQuery:
    return start(stream.writeStream.outputMode(mode).foreachBatch(handler), checkpoint, seconds)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that a stream dropped as behind the watermark since it was started.

    Spark keeps the reports of its last batches only; if some are gone, this refuses to answer.
    """
    reports = query.recentProgress
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(reports) >= kept:
        raise RuntimeError(f"only the last {kept} reports are kept: raise spark.sql.streaming.numRecentProgressUpdates")
    return sum(state.numRowsDroppedByWatermark for batch in reports for state in batch.stateOperators)


def print_stream(
    stream: DataFrame, checkpoint: str, mode: str = "append", rows: int = 10, seconds: int | None = BATCH_SECONDS
) -> StreamingQuery:
    """Show the first rows of every batch on the console."""
    writer = stream.writeStream.outputMode(mode).format("console").option("numRows", rows)
    return start(writer.option("truncate", False), checkpoint, seconds)


def print_topic(topic: DataFrame, checkpoint: str, seconds: int | None = PUBLISH_SECONDS) -> StreamingQuery:
    """Print a topic's records as quoted lines; open it from its beginning to see all."""
    lines = topic.select(texts.quoted_line(F.col("timestamp"), F.col("value")).alias("line"))
    return print_stream(lines, checkpoint, seconds=seconds)


def publish_to_folder(
    lines: DataFrame, path: str, checkpoint: str, seconds: int | None = PUBLISH_SECONDS
) -> StreamingQuery:
    """Append a stream of lines (`value`) to a topic folder, stamped on arrival."""
    records = lines.select("value", F.current_timestamp().alias("timestamp"))
    writer = records.writeStream.outputMode("append").format("parquet").option("path", path)
    return start(writer, checkpoint, seconds)


def publish_to_kafka(
    lines: DataFrame, servers: str, topic: str, checkpoint: str, seconds: int | None = PUBLISH_SECONDS
) -> StreamingQuery:
    writer = (
        lines.select("value").writeStream.outputMode("append").format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
    )
    return start(writer, checkpoint, seconds)


def replay_files(spark, path: str, files_per_batch: int = 1) -> DataFrame:
    """Text files as a stream of lines, the oldest first, `files_per_batch` at a time."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)


def count_batches(report: Callable[[int, int], None]) -> Handler:
    """A handler that reports (batch id, number of records) for every batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        report(batch_id, batch.count())

    return handle


def publish_in_order(
    records: DataFrame, path: str, slice_of, slices: int
) -> None:
    """Append topic records slice after slice, as a producer sending one file at a time would.

    `slice_of` numbers each record 0 .. slices-1. The slices are laid out as folders once, and
    their files are then moved into the topic, not written again (the file system has to rename
    files and keep the times they are given). Streams take files by age, so those of later
    slices are made younger. Files hold at most `RECORDS_PER_FILE` records: Spark reads a small
    file in one task, whatever it holds, so a few large ones would keep a stream's batch in a few tasks.
    """
    spark = records.sparkSession
    mark = uuid.uuid4().hex
    laid_out = f"{path}/_slices-{mark}"  # hidden from readers, and on the topic's file system
    # A rebalance writes few files per slice and splits a slice that holds most rows.
    (
        records.select("value", "timestamp", slice_of.cast("int").alias("slice"))
        .hint("rebalance", "slice").write.partitionBy("slice").option("maxRecordsPerFile", RECORDS_PER_FILE).parquet(laid_out)
    )
    found = []
    for number in range(slices):
        files, folder = hadoop_path(spark, f"{laid_out}/slice={number}")
        found.append(list(files.listStatus(folder)) if files.exists(folder) else [])
    # by the clock of the file system, which stamps what others append
    newest = max((e.getModificationTime() for entries in found for e in entries), default=0)
    for number, entries in enumerate(found):
        for entry in entries:
            # files of two slices may have one name
            files, moved = hadoop_path(spark, f"{path}/{mark}-{number}-{entry.getPath().getName()}")
            files.setTimes(entry.getPath(), newest + number, -1)
            if not files.rename(entry.getPath(), moved):
                raise RuntimeError(f"{entry.getPath().toString()} could not be moved to {moved.toString()}")
    if not any(found):
        # a stream runs no batch without a file
        records.select("value", "timestamp").limit(0).write.mode("append").parquet(path)
    files, left = hadoop_path(spark, laid_out)
    files.delete(left, True)
