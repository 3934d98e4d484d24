"""Word frequencies of whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyledger.functions import texts


def word_count(lines: DataFrame, text: str = "text") -> DataFrame:
    """Occurrences of each word; counts combine on the map side before the shuffle."""
    return (
        lines.select(F.explode(texts.words(F.col(text))).alias("word"))
        .where(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
