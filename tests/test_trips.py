from __future__ import annotations

import datetime as dt

import pytest
from conftest import GOLDEN, brute_trips, flight, golden_flights, random_flights
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators import legs
from skyledger.plans import itineraries


def as_set(frame):
    rows = frame.select(*schemas.TRIPS.fieldNames()).collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


def test_golden_trips(flights):
    trips = itineraries.trips(flights(golden_flights()))
    assert {(r["origin"], r["connection"], r["destination"]) for r in trips.collect()} == {g[0] for g in GOLDEN}
    assert trips.count() == 6


@pytest.mark.parametrize("route, first, second", GOLDEN)
def test_golden_lookup(spark, flights, tmp_path, route, first, second):
    path = str(tmp_path / "trips")
    itineraries.store_trips(itineraries.trips(flights(golden_flights())), path)
    stored = spark.read.schema(schemas.TRIPS).parquet(path)
    found = itineraries.trip_lookup(stored, *route, first[0][:10])
    row = found.first()
    assert found.count() == 1
    assert row["origin_date_time"] == dt.datetime.fromisoformat(first[0])
    assert (row["origin_carrier"], row["origin_flight"], row["connection_arr_delay"]) == first[1:]
    assert row["connection_date_time"] == dt.datetime.fromisoformat(second[0])
    assert (row["connection_carrier"], row["connection_flight"], row["destination_arr_delay"]) == second[1:]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "origin_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "EqualTo(origin," in plan


@pytest.mark.parametrize("pm_from_hour", [12, 13])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(flights, seed, pm_from_hour):
    rows = random_flights(seed)
    expected = brute_trips(rows, pm_from_hour)
    assert len(expected) > 50
    assert as_set(itineraries.trips(flights(rows), pm_from_hour)) == expected


def test_noon_departures(flights):
    rows = [
        flight("2008-01-01T08:00", origin="X", dest="Y"),
        flight("2008-01-03T12:30", origin="Y", dest="Z"),
    ]
    assert itineraries.trips(flights(rows)).count() == 1
    assert itineraries.trips(flights(rows), pm_from_hour=13).count() == 0


def test_ties_fall_to_time_then_carrier_then_number(flights):
    rows = [
        flight("2008-01-01T09:00", "AA", "1", "X", "Y"),
        flight("2008-01-01T08:00", "UA", "9", "X", "Y"),
        flight("2008-01-01T08:00", "DL", "7", "X", "Y"),
        flight("2008-01-01T08:00", "DL", "5", "X", "Y"),
        flight("2008-01-03T18:00", "AA", "2", "Y", "Z"),
    ]
    row = itineraries.trips(flights(rows)).first()
    assert (row["origin_carrier"], row["origin_flight"]) == ("DL", "5")


def test_unknown_departure_is_no_leg(flights):
    bad = list(flight("2008-01-01T08:00", origin="X", dest="Y"))
    bad[2] = None
    rows = [tuple(bad), flight("2008-01-03T18:00", origin="Y", dest="Z")]
    assert itineraries.trips(flights(rows)).count() == 0


def rows_scanned(frame):
    """Rows that come out of the file scan when `frame` runs, and what it returns."""
    found = frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().get("numOutputRows").get().value(), found


def test_lookup_reads_few_rows_of_a_date(spark, tmp_path):
    """200,000 trips of one date, in several row groups."""
    day, n = dt.date(2008, 1, 1), 200_000
    moment = F.lit(dt.datetime(2008, 1, 1, 8)).cast("timestamp_ntz")
    values = {
        "origin": F.concat(F.lit("O"), F.col("id") % 317), "connection": F.concat(F.lit("C"), F.col("id") % 53),
        "destination": F.concat(F.lit("D"), F.col("id") % 1009), "origin_date": F.lit(day), "origin_flight": F.col("id"),
    }
    rows = spark.range(n).select(*[
        values.get(f.name, moment if f.dataType.typeName() == "timestamp_ntz" else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.TRIPS
    ])
    path = str(tmp_path / "trips")
    itineraries.store_trips(rows, path, row_group_bytes=1 << 20)
    stored = itineraries.stored_trips(spark, path)
    assert stored.count() == n
    key = ("O%d" % (1234 % 317), "C%d" % (1234 % 53), "D%d" % (1234 % 1009), day)
    scanned, found = rows_scanned(itineraries.trip_lookup(stored, *key))
    assert [r["origin_flight"] for r in found] == ["1234"] and stored.columns[:-1] == found[0].__fields__
    assert scanned <= n // 4
    plain, same = rows_scanned(itineraries.trip_lookup(stored.drop("route_key"), *key))
    assert same == found and plain > scanned
    absent = [rows_scanned(itineraries.trip_lookup(stored, f"O{i}", "C0", "nowhere", day)) for i in range(10)]
    assert all(not rows for _, rows in absent) and sum(n == 0 for n, _ in absent) >= 8


def test_one_scan_and_one_leg_shuffle(spark, flights, tmp_path):
    flights(random_flights(3)).write.parquet(str(tmp_path / "f"))
    trips = itineraries.trips(spark.read.schema(schemas.FLIGHTS).parquet(str(tmp_path / "f")))
    trips.collect()
    plan = trips._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_text_and_millis_forms(flights):
    trips = itineraries.trips(flights(golden_flights())).where(F.col("origin") == "CMI")
    text = itineraries.trips_as_text(trips).first()
    assert text["origin_date"] == "2008-03-04"
    assert text["origin_date_time"] == "2008-03-04T07:10:00.000000Z"
    millis = itineraries.trips_as_millis(trips).first()
    assert millis["origin_date"] == 1204588800000
    assert millis["connection_date_time"] == 1204833000000


def test_a_leg_without_delay_never_wins(flights):
    rows = [flight("2008-03-04T07:00", num="1", arr=-5.0), flight("2008-03-04T07:10", num="2")]
    rows[1] = (*rows[1][:9], None)
    kept = legs.best_legs(legs.timed_legs(flights(rows))).collect()
    assert [(r["flight"], r["arrival_delay"]) for r in kept] == [("1", -5.0)]
