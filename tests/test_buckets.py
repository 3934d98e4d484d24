"""Rows in buckets: no shuffle of what is stored, whatever happens to the catalog or the number of buckets."""

from __future__ import annotations

import datetime as dt

from conftest import brute_trips, random_flights
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators import legs
from skyledger.streaming.trips import TripTables


def best(flights, rows):
    return legs.best_legs(legs.timed_legs(flights(rows)))


def stored(spark, tables):
    return {tuple(r) for r in tables.trips(spark).select(*schemas.TRIPS.fieldNames()).collect()}


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_stored_legs_are_not_shuffled(spark, flights, tmp_path):
    rows = random_flights(21)
    tables = TripTables(str(tmp_path / "t"))
    tables.store_batch(spark, best(flights, rows[:300]), 0)
    tables.store_batch(spark, best(flights, rows), 1)
    assert stored(spark, tables) == brute_trips(rows)
    now = tables.tables.open(spark)
    merged = tables.merged(spark, now.name("legs")[-1], 2, dt.date(2008, 1, 1), dt.date(2008, 1, 9))
    plan = executed(merged)
    assert "Exchange" not in plan and "Bucketed: true" in plan and plan.count("FileScan") == 1
    near = tables.near.read(spark, [tables.near.write(merged.withColumn("fresh", F.lit(True)), "9-x")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(tables.renewed(near))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_a_lost_catalog_and_another_number_of_buckets(spark, flights, tmp_path):
    rows = random_flights(22)
    path = str(tmp_path / "t")
    tables = TripTables(path)
    tables.store_batch(spark, best(flights, rows[:200]), 0)
    # a new session's catalog knows nothing of the folders
    spark.sql(f"DROP TABLE {tables.tables._buckets('legs').table(spark)}")
    tables.store_batch(spark, best(flights, rows[:400]), 1)
    assert stored(spark, tables) == brute_trips(rows[:400])
    tables = TripTables(path, buckets=7)
    tables.store_batch(spark, best(flights, rows), 2)
    tables.fold(spark, 2, 2)
    assert stored(spark, tables) == brute_trips(rows)
    assert all("/by7/" in n for n in tables.tables.open(spark).name("legs"))
    assert tables.legs(spark).count() == best(flights, rows).count()


def test_what_another_writer_left_is_found_and_removed_folders_are_forgotten(spark, flights, tmp_path):
    tables = TripTables(str(tmp_path / "t"))
    rows = random_flights(23)
    for batch in range(6):
        tables.store_batch(spark, best(flights, rows[: 100 * (batch + 1)]), batch)
        tables.tables.keep = 2
        tables.fold(spark, batch, 2)
    assert stored(spark, tables) == brute_trips(rows)
    kept = tables.tables._buckets("legs").folders(spark)
    assert len(kept) < 9
    assert tables.near.folders(spark) and len(tables.near.folders(spark)) == 1


def test_rows_without_a_date_are_kept_and_pair_with_none(spark, flights, tmp_path):
    tables = TripTables(str(tmp_path / "t"))
    good = best(flights, random_flights(24))
    odd = good.limit(1).withColumn("date", F.lit(None).cast("date"))
    tables.store_batch(spark, good.unionByName(odd), 0)
    assert tables.legs(spark).where("date IS NULL").count() == 1
    assert stored(spark, tables) == brute_trips(random_flights(24))
