"""Contiguous shards of near-equal bytes, by global prefix sums over DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from skyledger.session import stage

ROW_BYTES = 8  # counted for each row beside its text


def balanced_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Cuts docs (`doc_id`, `text`), in the order of doc_id, into `shards` runs of equal bytes.

    Returns per row: `doc_id`, `size` (UTF-8 bytes of the text, none for null, plus 8),
    `text_crc32` (0 for null or empty), `law` (`bytes`), `shard`, `slot` (place in its
    shard, from 0 without gaps) and `grown_shard` (null: another number of shards cuts
    anew). A row goes to the shard in which its middle byte lies, so a shard is off the
    mean by a row at most. Null ids come first; rows of one id follow by checksum and size,
    and equal rows are interchangeable. An empty table gives an empty result; with fewer
    rows than shards some shards stay empty.

    Only ids, sizes and checksums are shuffled, once. A range partition keeps its rows in
    order and knows its totals; running sums over partitions (one row each) and within
    partitions add up to global ones. The last sort key is a row's place in the input, so a
    single repeated row spreads over partitions too.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"))
    order = ["doc_id", "text_crc32", "size", "place"]
    ranged = rows.repartitionByRange(*[F.asc_nulls_first(c) for c in order])
    # written once: partitions and their order must be the same whenever they are read
    parts = stage(ranged.withColumn("part", F.spark_partition_id()), "shard-rows")
    totals = parts.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes"))
    within = Window.partitionBy("part").orderBy(*[F.asc_nulls_first(c) for c in order])
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (parts.withColumn("upto", F.sum("size").over(upto)).withColumn("nth", F.row_number().over(within))
              .join(F.broadcast(offsets), "part")  # one row per partition
              .withColumn("row", F.expr("rows_before + nth - 1"))
              .withColumn("shard", F.expr(f"CAST(({shards} * CAST(2 * (bytes_before + upto) - size AS DECIMAL(30, 0))) div (2 * all_bytes) AS INT)")))
    placed = stage(placed.select("doc_id", "size", "text_crc32", "shard", "row"), "shard-places")
    first = placed.groupBy("shard").agg(F.min("row").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
