"""Means by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def mean_by(records: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Mean of `value` per key; sum and count combine on the map side."""
    return records.groupBy(*keys).agg(F.avg(value).alias(name))
