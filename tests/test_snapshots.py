"""Tables that change together, read while batches, folds and replacements are under way."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F, types as T

from skyledger.sinks.snapshots import Snapshots, Table

A = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("day", T.IntegerType()), T.StructField("v", T.StringType())])
B = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("total", T.IntegerType())])


@pytest.fixture
def tables(tmp_path):
    return Snapshots(str(tmp_path / "set"), {"a": Table(A, ("k", "day"), "day"), "b": Table(B, ("k",))}, keep=3)


def store(spark, tables, batch, a, b):
    written = {"a": tables.write(spark.createDataFrame(a, A), "a", batch)}
    if b is None:
        return None  # stopped between the two writes
    written["b"] = tables.write(spark.createDataFrame(b, B), "b", batch)
    return tables.publish(spark, batch, written)


def rows(spark, tables, name, version=None, where=None):
    return sorted(tuple(r)[:-1] for r in tables.latest(spark, name, version, where).collect())


def test_newest_row_per_key_in_both_tables(spark, tables):
    assert rows(spark, tables, "a") == [] and rows(spark, tables, "b") == []
    store(spark, tables, 0, [(1, 1, "x"), (2, 1, "y")], [(1, 10)])
    store(spark, tables, 1, [(1, 1, "z"), (3, 2, None)], [(1, 11), (2, 5)])
    assert rows(spark, tables, "a") == [(1, 1, "z"), (2, 1, "y"), (3, 2, None)]
    assert rows(spark, tables, "b") == [(1, 11), (2, 5)]
    assert rows(spark, tables, "a", where=F.col("day") == 2) == [(3, 2, None)]
    assert rows(spark, tables, "a", tables.open(spark, before=1)) == [(1, 1, "x"), (2, 1, "y")]


def test_a_batch_stopped_between_its_writes_does_not_show(spark, tables):
    store(spark, tables, 0, [(1, 1, "x")], [(1, 10)])
    store(spark, tables, 1, [(1, 1, "lost"), (9, 9, "lost")], None)
    assert rows(spark, tables, "a") == [(1, 1, "x")] and rows(spark, tables, "b") == [(1, 10)]
    # its replay writes new folders; what the stopped attempt left goes later
    store(spark, tables, 1, [(1, 1, "new")], [(1, 20)])
    assert rows(spark, tables, "a") == [(1, 1, "new")] and rows(spark, tables, "b") == [(1, 20)]


def test_a_reader_in_the_middle_of_a_batch(spark, tables):
    store(spark, tables, 0, [(1, 1, "x")], [(1, 10)])
    opened = tables.open(spark)
    frame = tables.latest(spark, "b", opened)
    tables.write(spark.createDataFrame([(1, 1, "half")], A), "a", 1)
    assert rows(spark, tables, "a") == [(1, 1, "x")]
    store(spark, tables, 1, [(1, 1, "y")], [(1, 11)])
    # one that opened before the batch keeps both tables as they were
    assert rows(spark, tables, "a", opened) == [(1, 1, "x")] and [r["total"] for r in frame.collect()] == [10]


def test_a_batch_published_twice_counts_once(spark, tables):
    store(spark, tables, 0, [(1, 1, "x")], [(1, 10)])
    store(spark, tables, 1, [(1, 1, "first"), (5, 5, "only then")], [(1, 11)])
    reader = tables.open(spark)
    store(spark, tables, 1, [(1, 1, "second")], [(1, 12)])
    assert rows(spark, tables, "a") == [(1, 1, "second")] and rows(spark, tables, "b") == [(1, 12)]
    assert rows(spark, tables, "a", reader) == [(1, 1, "first"), (5, 5, "only then")]


def test_folds_leave_earlier_readers_their_files(spark, tables):
    for batch in range(4):
        store(spark, tables, batch, [(batch, batch, f"v{batch}"), (7, 7, f"w{batch}")], [(7, batch)])
    before = tables.open(spark)
    expected = rows(spark, tables, "a", before), rows(spark, tables, "b", before)
    tables.fold(spark, 3, 3)
    after = tables.open(spark)
    assert [len(after.name(t)) for t in ("a", "b")] == [1, 1] and after.number > before.number
    assert (rows(spark, tables, "a", before), rows(spark, tables, "b", before)) == expected
    assert (rows(spark, tables, "a"), rows(spark, tables, "b")) == expected
    tables.fold(spark, 3, 3)  # again, as a replay does
    assert (rows(spark, tables, "a"), rows(spark, tables, "b")) == expected
    # a replayed batch finds the state before it, and the fold's base does not hide its rows
    store(spark, tables, 3, [(3, 3, "again"), (7, 7, "w9")], [(7, 9)])
    assert (7, 7, "w9") in rows(spark, tables, "a") and rows(spark, tables, "b") == [(7, 9)]


def test_old_versions_and_their_folders_go(spark, tables):
    for batch in range(9):
        store(spark, tables, batch, [(1, 1, f"v{batch}")], [(1, batch)])
        tables.fold(spark, batch, 2)
    assert len(tables.versions(spark)) <= 4
    assert len(os.listdir(f"{tables.path}/a/changes")) + len(os.listdir(f"{tables.path}/a/base")) < 9
    for number in tables.versions(spark):
        version = tables.load(spark, number)
        assert rows(spark, tables, "a", version) == [(1, 1, f"v{version.batch}")]
        assert rows(spark, tables, "b", version) == [(1, version.batch)]


def test_replacing_one_table(spark, tables):
    store(spark, tables, 0, [(1, 1, "x")], [(1, 10)])
    before = tables.open(spark)
    tables.replace(spark, 0, {"b": spark.createDataFrame([(4, 4)], B)})
    assert rows(spark, tables, "b") == [(4, 4)] and rows(spark, tables, "a") == [(1, 1, "x")]
    assert rows(spark, tables, "b", before) == [(1, 10)]
    store(spark, tables, 1, [(2, 2, "y")], [(4, 5)])
    assert rows(spark, tables, "b") == [(4, 5)]


def test_two_writers_are_noticed(spark, tables, monkeypatch):
    store(spark, tables, 0, [(1, 1, "x")], [(1, 10)])
    monkeypatch.setattr(Snapshots, "versions", lambda self, spark: [])
    with pytest.raises(RuntimeError):
        tables._publish(spark, 1, {})
