"""The written export, whose text is compressed in files of few records."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F
from test_topics import tables  # noqa: F401

from skyledger import schemas
from skyledger.catalog import queries
from skyledger.session import folder_size


def test_export_takes_a_fraction_of_its_text(spark, tables, monkeypatch):  # noqa: F811
    monkeypatch.setattr(queries, "EXPORT_RECORDS", 500, raising=False)
    path = queries._written_export(spark, tables, schemas.RAW_ON_TIME)
    text = spark.read.text(path)
    size = text.agg(F.sum(F.length("value") + 1)).first()[0]
    assert folder_size(spark, path.rpartition("/")[0])[1] < size / 2
    assert text.where("value NOT LIKE '%\"Year\"%'").count() == 3600 // 2 == queries.csv_clean_on_time(spark, tables).count()
    # with a header line each
    counts = [r["count"] for r in text.groupBy(F.input_file_name()).count().collect()]
    assert len(counts) == len(glob.glob(path)) >= 4 and max(counts) <= 501
