"""Topic folders of many files, and the streams over them."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from conftest import brute_trips
from pyspark.sql import DataFrameWriter, functions as F

from skyledger import schemas
from skyledger.catalog import flights as derived, queries
from skyledger.plans import cleaning
from skyledger.sources import topics
from skyledger.streaming import runs


@pytest.fixture
def tables(spark, tmp_path):
    """Order lines of a few airports and days, two for each of 900 orders."""
    lines = [(o, o % 4, 3 + (o // 3 + n) % 5, n, float((o * 7 + n) % 50)) for o in range(900) for n in (1, 3)]
    spark.createDataFrame(
        lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double"
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(o, o // 7 % 5) for o in range(900)], "o_orderkey bigint, o_custkey bigint").write.parquet(
        str(tmp_path / "orders.parquet"))
    return str(tmp_path)


@pytest.fixture
def small_files(spark, monkeypatch):
    monkeypatch.setattr(runs, "RECORDS_PER_FILE", 20, raising=False)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 20)
    yield
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")


@pytest.mark.parametrize("rounds, year, closing", [(4, None, False), (6, 2008, True)])
def test_files_of_a_topic_hold_few_records(spark, tables, tmp_path, monkeypatch, rounds, year, closing):
    """Of the incremental and of the windowed queries; the latter have two closing records more."""
    monkeypatch.setattr(runs, "RECORDS_PER_FILE", 50, raising=False)
    folder = queries.publish_records(spark, tables, rounds, year, closing)
    sizes = [r["count"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()]
    sent = cleaning.clean_on_time(derived.raw_flights(spark, tables), year).count()
    assert sum(sizes) == sent + 2 * closing and max(sizes) <= 50


@pytest.mark.parametrize("query", [queries.stream_trips_windowed, queries.stream_trips_joined])
def test_windows_over_slices_of_many_files(spark, tables, small_files, query):
    """A batch that ends within a slice leaves no record behind the watermark."""
    rows = [tuple(r) for r in cleaning.clean_on_time(
        derived.raw_flights(spark, tables, with_arrival=True), 2008, keep=["timestamp"]
    ).select(*schemas.FLIGHTS.fieldNames(), F.unix_seconds("timestamp")).collect()]
    expected = set()
    for start in range(derived.ARRIVAL_START - 6, derived.ARRIVAL_START + derived.ARRIVAL_SPAN, 6):
        inside = [r[:-1] for r in rows if start <= r[-1] < start + 12]
        expected |= {(*t, start) for t in brute_trips(inside)}
    assert len(expected) > 100 and isinstance(rows[0][2], dt.datetime)
    got = query(spark, tables).collect()
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_records_of_a_topic_are_written_once(spark, tmp_path, monkeypatch):
    """Slices were written, read and written again. Later ones are younger, and a topic can be added to."""
    monkeypatch.setattr(runs, "RECORDS_PER_FILE", 50)
    path, written = str(tmp_path / "topic"), []
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("value"), F.timestamp_seconds(F.col("id")).alias("timestamp"))
    parquet = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, to, *a, **k: (written.append(to), parquet(self, to, *a, **k))[1])
    # the slice 1 of 4 is empty, a null slice is none
    part = F.when(F.col("timestamp") < F.timestamp_seconds(F.lit(390)), F.floor(F.col("value") / 100)).cast("int")
    part = F.when(part == 1, F.lit(2)).otherwise(part)
    for turn in range(2):
        runs.publish_in_order(rows, path, part, 4)
        assert len(written) == turn + 1
    files = sorted((os.stat(p).st_mtime_ns // 1_000_000, p) for p in glob.glob(f"{path}/*.parquet"))
    assert [p for p in os.listdir(path) if p.startswith("_slices")] == []
    seen, values = [], []
    for _, file in files:
        own = [int(r["value"]) for r in spark.read.parquet(file).collect()]
        assert 0 < len(own) <= 50
        seen.append(max(v // 100 if v // 100 != 1 else 2 for v in own))
        values += own
    half = len(seen) // 2
    assert seen[:half] == sorted(seen[:half]) == seen[half:] and sorted(set(seen)) == [0, 2, 3]
    assert sorted(values) == sorted([*range(390)] * 2)
    stream = topics.read_topic_folder(spark, path, files_per_batch=1)
    got = []
    runs.each_batch(stream, lambda batch, _: got.append({int(r["value"]) // 100 for r in batch.collect()}),
                    str(tmp_path / "cp"), "append", seconds=None).awaitTermination()
    assert [max(g) if g != {1} else 2 for g in got] == seen


def test_topic_without_records_has_a_batch(spark, tmp_path):
    rows = spark.range(9).select(F.col("id").cast("string").alias("value"), F.timestamp_seconds("id").alias("timestamp"))
    path, seen = str(tmp_path / "topic"), []
    runs.publish_in_order(rows.where("value = 'none'"), path, F.lit(0), 4)
    stream, _ = queries.open_topic(spark, path, 4)
    runs.each_batch(stream, runs.count_batches(lambda *batch: seen.append(batch)), str(tmp_path / "cp"), "append",
                    seconds=None).awaitTermination()
    assert seen == [(0, 0)]
