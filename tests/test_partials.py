"""Sums of a backfill and of a stream add up to one answer."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import types as T

from skyledger.sinks.partials import PartialSums

KEY = T.StructType([T.StructField("k", T.StringType())])
ROW = T.StructType([*KEY.fields, T.StructField("v", T.DoubleType())])


@pytest.fixture
def sums(tmp_path):
    return PartialSums(str(tmp_path / "sums"), KEY)


def frame(spark, rows):
    return spark.createDataFrame(rows, ROW)


def means(spark, sums):
    rows = sums.means(spark, "mean").collect()
    assert len({r["k"] for r in rows}) == len(rows)
    return {r["k"]: r["mean"] for r in rows}


def test_parts_add_up(spark, sums):
    assert means(spark, sums) == {}
    sums.add("stream", frame(spark, [("a", 4.0), ("a", None), (None, 1.0), ("n", None)]), "v", 0, 100)
    sums.backfill("past", frame(spark, [("a", 1.0), ("b", 2.0)]), "v")
    sums.add("stream", frame(spark, [("a", 1.0), (None, 2.0)]), "v", 1, 100)
    assert means(spark, sums) == {"a": 2.0, "b": 2.0, None: 1.5, "n": None}
    assert sums.parts(spark) == ["past", "stream"]


def test_a_replayed_batch_and_a_repeated_backfill_count_once(spark, sums):
    for _ in range(3):
        sums.backfill("past", frame(spark, [("a", 1.0)]), "v")
    sums.add("stream", frame(spark, [("a", 2.0)]), "v", 0, 100)
    sums.add("stream", frame(spark, [("a", 99.0)]), "v", 1, 100)
    sums.add("stream", frame(spark, [("a", 3.0)]), "v", 1, 100)
    assert means(spark, sums) == {"a": 2.0}
    # an empty backfill leaves the stream's own
    sums.backfill("past", frame(spark, []), "v")
    assert means(spark, sums) == {"a": 2.5}


@pytest.mark.parametrize("fold_every", [1, 3])
def test_folds_add_and_replays_after_them_do_not(spark, sums, fold_every):
    for batch in range(7):
        sums.add("stream", frame(spark, [("a", float(batch)), (f"k{batch}", 1.0)]), "v", batch, fold_every)
        sums.add("stream", frame(spark, [("a", float(batch)), (f"k{batch}", 1.0)]), "v", batch, fold_every)
    assert means(spark, sums) == {"a": 3.0, **{f"k{b}": 1.0 for b in range(7)}}
    row = sums.sums(spark).where("k = 'a'").first()
    assert (row["n"], row["total"]) == (7, 21.0)


def test_folders_of_replaced_backfills_go(spark, sums):
    for i in range(25):
        sums.backfill("past", frame(spark, [("a", float(i))]), "v")
    assert means(spark, sums) == {"a": 24.0}
    assert len(os.listdir(f"{sums.path}/part=past/sums/base")) <= 21
