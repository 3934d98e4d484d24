from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F, types as T

from skyledger.plans import itineraries
from skyledger import schemas
from skyledger.session import folder_size
from skyledger.sinks import files
from skyledger.sinks.keyed import KeyedTable
from skyledger.sources import files as sources
from conftest import golden_flights

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])


def rows(spark, **values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def content(frame):
    return {r["k"]: r["v"] for r in frame.collect()}


@pytest.fixture
def table(tmp_path):
    return KeyedTable(str(tmp_path / "t"), SCHEMA, ["k"], sort_by="k")


def test_last_write_wins(spark, table):
    table.upsert(rows(spark, a=1, b=2), 0)
    table.upsert(rows(spark, b=3, c=4), 1)
    assert content(table.latest(spark)) == {"a": 1, "b": 3, "c": 4}
    assert content(table.latest(spark, upto=0)) == {"a": 1, "b": 2}
    assert content(table.lookup(spark, k="b")) == {"b": 3}
    assert content(table.changes(spark, 1)) == {"b": 3, "c": 4}


def test_replayed_batch_changes_nothing(spark, table):
    table.upsert(rows(spark, a=1), 0)
    table.upsert(rows(spark, a=2, b=5), 1)
    table.upsert(rows(spark, a=2, b=5), 1)
    assert content(table.latest(spark)) == {"a": 2, "b": 5}
    assert table.latest(spark).count() == 2


def test_empty_batch(spark, table):
    table.upsert(rows(spark, a=1).where("false"), 0)
    assert content(table.latest(spark)) == {}


def test_compaction(spark, table):
    for i in range(5):
        table.upsert(rows(spark, a=i, **{f"k{i}": i}), i)
    expected = content(table.latest(spark))
    table.compact(spark, 3)
    assert content(table.latest(spark)) == expected
    # An unfinished base does not count.
    table.latest(spark, upto=1).write.parquet(f"{table.path}/base/upto=9")
    marker = glob.glob(f"{table.path}/base/upto=9/_SUCCESS")[0]
    spark._jvm.java.io.File(marker).delete()
    assert content(table.latest(spark)) == expected
    table.forget_folded(spark)
    assert content(table.latest(spark)) == expected
    left = {p.rsplit("=")[-1] for p in glob.glob(f"{table.path}/changes/batch_id=*")}
    assert left == {"4"}
    table.upsert(rows(spark, a=99), 5)
    assert content(table.latest(spark))["a"] == 99


def test_replace_drops_what_was_there(spark, table):
    table.upsert(rows(spark, a=1), 0)
    table.upsert(rows(spark, b=1), 1)
    table.compact(spark, 1)
    table.replace(rows(spark, c=3))
    assert content(table.latest(spark)) == {"c": 3}
    table.upsert(rows(spark, d=4), 0)
    assert content(table.latest(spark)) == {"c": 3, "d": 4}


def test_key_filter_reaches_the_scan(spark, table):
    table.upsert(rows(spark, a=1, b=2), 0)
    plan = table.lookup(spark, k="b")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,b)" in plan


def test_single_csv_with_header(spark, tmp_path):
    path = str(tmp_path / "one")
    files.write_single_csv(spark.range(100).repartition(4), path, header=True)
    parts = glob.glob(f"{path}/part-*")
    assert len(parts) == 1
    text = open(parts[0], newline="").read()
    assert text.startswith("id\n") and "\r" not in text and text.count("\n") == 101


def test_quoted_csv(spark, tmp_path):
    path = str(tmp_path / "q")
    files.write_quoted_csv(rows(spark, ORD=3).coalesce(1), path)
    assert open(glob.glob(f"{path}/part-*")[0]).read() == '"ORD","3"\n'


def test_result_csv_loads_back(spark, flights, tmp_path):
    path = str(tmp_path / "trips")
    trips = itineraries.trips(flights(golden_flights()))
    files.write_csv(trips, path)
    files.write_csv(trips, path)
    loaded = sources.read_result_csv(spark, path, schemas.TRIPS)
    assert set(loaded.collect()) == set(trips.collect())
    assert loaded.count() == 6


def test_text_with_quotes_and_commas_survives(spark, tmp_path):
    schema = T.StructType.fromDDL("a string, b string")
    frame = spark.createDataFrame([('say "hi"', "x,y"), ("{(A),(B)}", None)], schema)
    files.write_csv(frame, str(tmp_path / "c"))
    loaded = sources.read_result_csv(spark, str(tmp_path / "c"), schema)
    assert set(map(tuple, loaded.collect())) == set(map(tuple, frame.collect()))


def test_folder_size(spark, tmp_path):
    path = tmp_path / "f"
    (path / "a").mkdir(parents=True)
    (path / "a" / "x").write_text("12345")
    (path / "y").write_text("678")
    assert folder_size(spark, str(path)) == (2, 8)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_fold_may_be_repeated(spark, table, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for batch in range(4):
            table.upsert(rows(spark, a=batch, **{f"k{batch}": batch}), batch)
        for _ in range(3):
            table.fold(spark, 3, 3)
            assert content(table.latest(spark)) == {"a": 3, "k0": 0, "k1": 1, "k2": 2, "k3": 3}
        table.upsert(rows(spark, a=9), 4)
        table.fold(spark, 6, 3)
        table.fold(spark, 9, 3)
        assert content(table.latest(spark))["a"] == 9
        bases = {p.rsplit("=")[-1] for p in glob.glob(f"{table.path}/base/upto=*")}
        assert bases == {"6", "9"} and not glob.glob(f"{table.path}/changes/batch_id=*")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_an_unfinished_replacement_does_not_count(spark, table):
    table.upsert(rows(spark, a=1), 0)
    rows(spark, b=2).withColumn("batch_id", F.lit(-1)).write.partitionBy("batch_id").parquet(
        f"{table.path}/generation=1/changes")
    assert content(table.latest(spark)) == {"a": 1}
    table.replace(rows(spark, c=3))
    assert content(table.latest(spark)) == {"c": 3}
    table.replace(rows(spark, d=4))
    assert content(table.latest(spark)) == {"d": 4}
