"""Text-file readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from skyledger import schemas
from skyledger.functions import clock
from skyledger.sources import records


def _quoted_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # The export doubles a quote inside a quoted field; header rows are told apart
    # by the year filter of the cleaning step, as a glob mixes many files.
    return (
        spark.read.schema(schema).option("quote", '"').option("escape", '"').csv(path)
    )


def read_on_time_csv(spark: SparkSession, path: str) -> DataFrame:
    """The 55-column on-time export; `path` may be a glob."""
    return _quoted_csv(spark, path, schemas.RAW_ON_TIME)


def read_coupon_csv(spark: SparkSession, path: str) -> DataFrame:
    """The 34-column origin/destination coupon export; `path` may be a glob."""
    return _quoted_csv(spark, path, schemas.RAW_COUPONS)


def _tsv_text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schemas.text_schema(schema))
        .option("sep", "\t")
        .option("quote", "")
        .csv(path)
    )


def read_flights_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned flights, ten tab-separated columns."""
    return records.typed_flights(_tsv_text(spark, path, schemas.FLIGHTS))


def read_coupons_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned coupons, three tab-separated columns."""
    return records.typed_coupons(_tsv_text(spark, path, schemas.COUPONS))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files in one column `text`."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_result_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = False
) -> DataFrame:
    """A stored result, for loading it back into a table."""
    return (
        spark.read.schema(schema)
        .option("escape", '"')
        .option("header", header)
        .option("timestampNTZFormat", clock.ISO_MILLIS)
        .csv(path)
    )
