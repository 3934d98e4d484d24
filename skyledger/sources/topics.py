"""Record streams: (`value`, `timestamp`) rows from Kafka or from a topic folder.

A topic folder holds Parquet files with those two columns and stands in for a
broker wherever none is reachable; every pipeline accepts either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TOPIC = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("timestamp", T.TimestampType())]
)


def kafka_options(
    servers: str, topic: str, from_beginning: bool = False, max_per_batch: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest" if from_beginning else "latest",
    }
    if max_per_batch:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    return options


def read_kafka(
    spark: SparkSession, servers: str, topic: str,
    from_beginning: bool = False, max_per_batch: int | None = None,
) -> DataFrame:
    """A Kafka topic; needs Spark's Kafka connector on the class path."""
    options = kafka_options(servers, topic, from_beginning, max_per_batch)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"), "timestamp")


def read_topic_folder(
    spark: SparkSession, path: str, files_per_batch: int | None = None,
    bytes_per_batch: str | None = None,
) -> DataFrame:
    """A topic folder as a stream; the two limits play the part of back-pressure."""
    reader = spark.readStream.schema(TOPIC)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    elif bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(path)
