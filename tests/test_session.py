"""Staged tables, and their removal."""

from __future__ import annotations

import os

import pytest

from skyledger.session import new_path, scratch, shared_dir, stage


def staged(spark):
    root = shared_dir(spark).removeprefix("file:")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def test_staged_tables_go_with_their_block(spark, tmp_path):
    stage(spark.range(3), "stays")
    before = staged(spark)
    with scratch(spark):
        inner = stage(spark.range(5), "goes")
        new_path(spark, "never-written")
        assert len(staged(spark) - before) == 1
        inner.write.parquet(str(tmp_path / "out"))
    assert staged(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_they_go_after_an_error_and_by_the_innermost_block(spark):
    before = staged(spark)
    with scratch(spark):
        outer = stage(spark.range(2), "outer")
        with pytest.raises(ValueError), scratch(spark):
            stage(spark.range(3), "inner")
            raise ValueError
        assert len(staged(spark) - before) == 1 and outer.count() == 2
    assert staged(spark) == before
