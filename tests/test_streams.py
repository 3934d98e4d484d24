from __future__ import annotations

import datetime as dt
import glob
import re

import pytest
from conftest import brute_trips, flight, golden_flights, random_flights
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from skyledger import schemas
from skyledger.operators.legs import best_legs, by_leg, least_delayed, timed_legs
from skyledger.operators.traffic import endpoint_counts
from skyledger.plans import punctuality
from skyledger.session import stream_session
from skyledger.sinks import files
from skyledger.sinks.keyed import KeyedTable
from skyledger.sources import topics
from skyledger.sources.records import flight_lines, flights_from_lines
from skyledger.streaming import runs, running, trips as trip_streams

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def publish(spark, flights, tmp_path):
    """Append rounds of flights to a topic folder; each round becomes one batch."""
    folder = str(tmp_path / "topic")

    def send(*rounds, seconds=None):
        for i, rows in enumerate(rounds):
            at = F.lit(START + dt.timedelta(seconds=(seconds or [0] * len(rounds))[i]))
            records = flight_lines(flights(rows).coalesce(1)).withColumn("timestamp", at)
            records.write.mode("append").parquet(folder)
        return topics.read_topic_folder(stream_session(spark), folder, files_per_batch=1)

    return send


def thirds(rows):
    return [rows[0::3], rows[1::3], rows[2::3]]


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def last_csv(spark, out, schema):
    newest = max(int(p.rsplit("=")[-1]) for p in glob.glob(f"{out}/batch=*"))
    return spark.read.schema(schema).csv(f"{out}/batch={newest}")


def test_lines_round_trip_and_bad_fields(spark, flights):
    rows = flights(random_flights(5, 50))
    assert set(flights_from_lines(flight_lines(rows)).collect()) == set(rows.collect())
    bad = spark.createDataFrame([("x\tnot a date\t\t3",)], "value string")
    got = flights_from_lines(bad).first()
    assert got["year"] is None and got["flight_date"] is None and got["origin"] is None
    assert got["flight_datetime"] is None and got["day_of_week"] == "3"


def test_top_airports(spark, flights, publish, tmp_path):
    rows = random_flights(1)
    out = str(tmp_path / "out")
    run(running.top_airports(publish(*thirds(rows)), out, str(tmp_path / "cp"), n=2, seconds=None))
    assert len(glob.glob(f"{out}/batch=*")) >= 3
    got = last_csv(spark, out, "place int, airport string, total bigint")
    totals = sorted(((-r["total"], r["airport"]) for r in endpoint_counts(flights(rows)).collect()))[:2]
    assert [(r["airport"], r["total"]) for r in got.orderBy("place").collect()] == [(a, -t) for t, a in totals]
    text = open(glob.glob(f"{out}/batch=0/part-*")[0]).readline()
    assert text.count('"') == 6


def test_popularity_index(spark, flights, publish, tmp_path):
    rows = random_flights(2)
    out = str(tmp_path / "out")
    run(running.popularity_index(publish(*thirds(rows)), out, str(tmp_path / "cp"), seconds=None))
    got = [tuple(r) for r in last_csv(spark, out, "index bigint, total bigint").orderBy("index").collect()]
    totals = sorted((r["total"] for r in endpoint_counts(flights(rows)).collect()), reverse=True)
    assert got == list(enumerate(totals))


def test_weekday_delay(spark, flights, publish, tmp_path):
    rows = random_flights(3)
    out = str(tmp_path / "out")
    run(running.weekday_delay(publish(*thirds(rows)), out, str(tmp_path / "cp"), seconds=None))
    got = last_csv(spark, out, "day_of_week string, day_name string, avg_delay double").collect()
    expected = {r["day_of_week"]: r["avg_delay"] for r in punctuality.weekday_delay(flights(rows)).collect()}
    assert {r["day_of_week"]: r["avg_delay"] for r in got} == pytest.approx(expected)
    assert {r["day_name"] for r in got if r["day_of_week"] == "2"} == {"Tuesday"}
    newest = sorted(glob.glob(f"{out}/batch=*"))[-1]
    lines = [line for part in sorted(glob.glob(f"{newest}/part-*")) for line in open(part)]
    delays = [float(line.strip().replace('"', "").split(",")[-1]) for line in lines]
    assert len(delays) == len(expected) and delays == sorted(delays)


def test_mean_arrival_table(spark, flights, publish, tmp_path):
    rows = random_flights(4)
    table = KeyedTable(str(tmp_path / "means"), schemas.MEAN_DELAYS, ["origin", "destination"])
    run(running.mean_arrival_table(publish(*thirds(rows)), table, str(tmp_path / "cp"), seconds=None))
    got = table.latest(spark).drop("batch_id")
    assert set(got.collect()) == set(punctuality.mean_arrival_delay(flights(rows)).collect())


def test_ten_best_table(spark, flights, publish, tmp_path):
    rows = random_flights(6)
    ranked = KeyedTable(
        str(tmp_path / "r"), T.StructType.fromDDL("origin string, rank int, carrier string, avg_delay double"),
        ["origin", "rank"],
    )
    cells = ", ".join(f"c{i:02d} string" for i in range(1, 11))
    wide = KeyedTable(str(tmp_path / "w"), T.StructType.fromDDL(f"airport string, {cells}"), ["airport"])
    run(running.ten_best_table(publish(*thirds(rows)), "carrier", ranked, wide, "c", str(tmp_path / "cp"), seconds=None))
    best = punctuality.top_carriers(flights(rows))
    assert set(ranked.latest(spark).drop("batch_id").collect()) == set(best.collect())
    assert set(wide.latest(spark).drop("batch_id").collect()) == set(
        punctuality.as_wide_list(best, "carrier", "c").collect()
    )


def test_restart_continues_from_the_checkpoint(spark, flights, publish, tmp_path):
    rows = random_flights(7)
    table = KeyedTable(str(tmp_path / "means"), schemas.MEAN_DELAYS, ["origin", "destination"])
    run(running.mean_arrival_table(publish(rows[:300]), table, str(tmp_path / "cp"), seconds=None))
    run(running.mean_arrival_table(publish(rows[300:]), table, str(tmp_path / "cp"), seconds=None))
    got = table.latest(spark).drop("batch_id")
    assert set(got.collect()) == set(punctuality.mean_arrival_delay(flights(rows)).collect())


def stored_trips(spark, tables):
    rows = tables.trips(spark).select(*schemas.TRIPS.fieldNames()).collect()
    found = {tuple(r) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("fold_every", [1, 100])
def test_incremental_trips_equal_batch(spark, publish, tmp_path, fold_every):
    rows = random_flights(8)
    tables = trip_streams.TripTables(str(tmp_path / "tables"))
    run(trip_streams.incremental_trips(
        publish(*thirds(rows)), tables, str(tmp_path / "cp"), year=2008, seconds=None,
        session=spark, fold_every=fold_every,
    ))
    assert stored_trips(spark, tables) == brute_trips(rows)


def test_incremental_golden_with_second_legs_first(spark, publish, tmp_path):
    rows = golden_flights()
    tables = trip_streams.TripTables(str(tmp_path / "tables"))
    run(trip_streams.incremental_trips(publish(rows[1::2], rows[0::2]), tables, str(tmp_path / "cp"), seconds=None))
    assert stored_trips(spark, tables) == brute_trips(rows)
    assert tables.origins(spark).count() == 6 and tables.destinations(spark).count() == 6
    at = tables.legs_at(spark, "DFW", dt.date(2008, 9, 9)).collect()
    assert [(r["origin"], r["flight"]) for r in at] == [("JAX", "845")]


def test_better_leg_renews_its_trips(spark, publish, tmp_path):
    am = flight("2008-01-01T08:00", "AA", "1", "X", "Y", arr=5)
    pm = flight("2008-01-03T18:00", "AA", "2", "Y", "Z", arr=5)
    better = flight("2008-01-01T09:00", "UA", "3", "X", "Y", arr=-5)
    worse = flight("2008-01-03T19:00", "UA", "4", "Y", "Z", arr=9)
    tables = trip_streams.TripTables(str(tmp_path / "tables"))
    run(trip_streams.incremental_trips(publish([am], [pm], [better], [worse]), tables, str(tmp_path / "cp"), seconds=None))
    found = stored_trips(spark, tables)
    assert found == brute_trips([am, pm, better, worse])
    assert {(t[3], t[10]) for t in found} == {("3", "2")}


def test_replayed_trip_batch_changes_nothing(spark, publish, tmp_path):
    rows = random_flights(9, 200)
    tables = trip_streams.TripTables(str(tmp_path / "tables"))
    run(trip_streams.incremental_trips(publish(rows), tables, str(tmp_path / "cp"), seconds=None))
    before = stored_trips(spark, tables)
    legs = spark.createDataFrame(tables.legs(spark).collect(), schemas.LEGS)
    tables.store_batch(spark, legs, 0)
    assert stored_trips(spark, tables) == before
    # The same legs in a later batch change nothing either, and write no trip.
    tables.store_batch(spark, legs, 1)
    now = tables.tables.open(spark)
    assert now.batch == 1
    assert all(tables.tables.read(spark, now.name(t)[-1], t).count() == 0 for t in ("legs", "trips"))
    tables.store_batch(spark, legs.where("false"), 2)
    assert stored_trips(spark, tables) == before


def test_trips_after_an_empty_start(spark, publish, tmp_path):
    rows = golden_flights()
    other_year = [flight("2007-01-01T08:00", origin="X", dest="Y")]
    tables = trip_streams.TripTables(str(tmp_path / "tables"))
    assert tables.trips(spark).count() == 0
    run(trip_streams.incremental_trips(
        publish(other_year, rows[:6], rows[6:]), tables, str(tmp_path / "cp"), year=2008, seconds=None
    ))
    assert stored_trips(spark, tables) == brute_trips(rows)


def test_windowed_trips(spark, flights, publish, tmp_path):
    rows = random_flights(10, 400)
    rounds = [rows[i * 100:(i + 1) * 100] for i in range(4)]
    seconds = [0, 7, 20, 33]
    topic = publish(*rounds, rows[:1], seconds=[*seconds, 86400])
    out = str(tmp_path / "out")
    run(trip_streams.windowed_trips(topic, out, str(tmp_path / "cp"), seconds=None, session=spark))
    schema = schemas.extended(schemas.TRIPS, "window_start", T.LongType())
    got = spark.read.schema(schema).parquet(f"{out}/trips").select(*schema.fieldNames()).collect()

    expected = set()
    start = int(START.timestamp())
    for window in range(-6, 42, 6):
        inside = [r for s, part in zip(seconds, rounds) if window <= s < window + 12 for r in part]
        expected |= {(*t, start + window) for t in brute_trips(inside)}
    assert len(expected) > 20
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_joined_trips_and_their_state(spark, flights, publish, tmp_path):
    """One streaming plan gives the windows' trips, and its state ends with the windows."""
    rows = random_flights(10, 400)
    rounds = [rows[i * 100:(i + 1) * 100] for i in range(4)]
    seconds = [0, 7, 20, 33]
    halves = [[next(r for r in rows if (r[2].hour < 12) == morning)] for morning in (True, False)]
    topic = publish(*rounds, halves[0] + halves[1], seconds=[*seconds, 86400])
    out = str(tmp_path / "out")
    query = trip_streams.joined_trips(topic, out, str(tmp_path / "cp"), seconds=None)
    run(query)
    schema = schemas.extended(schemas.TRIPS, "window_start", T.LongType())
    got = spark.read.schema(schema).parquet(out).select(*schema.fieldNames()).collect()

    expected = set()
    start = int(START.timestamp())
    for window in range(-6, 42, 6):
        inside = [r for s, part in zip(seconds, rounds) if window <= s < window + 12 for r in part]
        expected |= {(*t, start + window) for t in brute_trips(inside)}
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)

    held = [sum(x.numRowsTotal for x in p.stateOperators) for p in query.recentProgress]
    assert {x.operatorName for p in query.recentProgress for x in p.stateOperators} == {"symmetricHashJoin", "stateStoreSave"}
    # only the two closing legs, each in two windows, are left
    assert held[-1] == 4 and max(held) > 100
    # as in any batch: legs of windows that the watermark had passed are gone
    assert held[-2] < max(held)


def test_replay_of_files_in_several_batches(spark, flights, tmp_path):
    rows = flights(random_flights(11, 90)).repartition(3)
    source, topic = str(tmp_path / "src"), str(tmp_path / "topic")
    files.write_flights_tsv(rows, source)
    lines = runs.replay_files(stream_session(spark), source)
    query = runs.publish_to_folder(lines, topic, str(tmp_path / "cp"), seconds=None)
    run(query)
    assert len(query.recentProgress) >= 3
    back = spark.read.schema(topics.TOPIC).parquet(topic)
    assert set(flights_from_lines(back).collect()) == set(rows.collect())


def test_console_print_and_batch_counts(spark, publish, tmp_path):
    rows = random_flights(12, 60)
    topic = publish(*thirds(rows))
    printed = runs.print_stream(topic, str(tmp_path / "cp1"), rows=2, seconds=None)
    run(printed)
    assert sum(p["numInputRows"] for p in printed.recentProgress) == 60
    assert "Console" in printed.lastProgress["sink"]["description"]
    printed = runs.print_topic(topic, str(tmp_path / "cp3"), seconds=None)
    run(printed)
    assert sum(p["numInputRows"] for p in printed.recentProgress) == 60
    seen = {}
    run(runs.each_batch(topic, runs.count_batches(seen.__setitem__), str(tmp_path / "cp2"), "append", seconds=None))
    assert sum(seen.values()) == 60 and len(seen) == 3


def test_processing_time_trigger(spark, publish, tmp_path):
    topic = publish(random_flights(13, 30))
    table = KeyedTable(str(tmp_path / "means"), schemas.MEAN_DELAYS, ["origin", "destination"])
    query = running.mean_arrival_table(topic, table, str(tmp_path / "cp"), seconds=1)
    try:
        query.processAllAvailable()
        assert table.latest(spark).count() > 0
    finally:
        query.stop()


def test_kafka_options():
    assert topics.kafka_options("h:9092", "ontime") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "ontime", "startingOffsets": "latest",
    }
    options = topics.kafka_options("h:9092", "ontime", from_beginning=True, max_per_batch=8000)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "8000"


def test_kafka_needs_its_connector(spark, tmp_path):
    """Without the connector Spark says so; reader and writer get as far as asking for it."""
    with pytest.raises(AnalysisException, match="kafka"):
        topics.read_kafka(spark, "h:9092", "ontime", from_beginning=True)
    (tmp_path / "in").mkdir()
    lines = runs.replay_files(spark, str(tmp_path / "in"))
    with pytest.raises(AnalysisException, match="kafka"):
        runs.publish_to_kafka(lines, "h:9092", "ontime", str(tmp_path / "cp"), seconds=None)


def test_one_airport_holding_a_third_of_all_records(spark, flights, publish, tmp_path):
    rows = [
        (*r[:6], "HUB", "HUB" if i % 6 == 0 else r[7], *r[8:]) if i % 3 == 0 else r
        for i, r in enumerate(random_flights(14, 900))
    ]
    tables = trip_streams.TripTables(str(tmp_path / "tables"))
    run(trip_streams.incremental_trips(
        publish(*thirds(rows)), tables, str(tmp_path / "cp"), seconds=None, session=spark
    ))
    assert stored_trips(spark, tables) == brute_trips(rows)


def sort_and_splits(df):
    """The plan's first sort, and how often it splits a line."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    return sorts[-1:], plan.count("split(")


@pytest.mark.parametrize("windowed", [False, True])
def test_legs_of_lines_are_split_once_and_sorted_by_a_number(spark, flights, windowed):
    """Lines were split for each field that a filter names, and legs sorted by texts."""
    lines = flight_lines(flights(random_flights(23))).withColumn("arrival_time", F.lit(START))
    lines = spark.createDataFrame(lines.collect(), lines.schema)
    legs = timed_legs(flights_from_lines(lines, keep=["arrival_time"]).where("year = 2008"))
    if windowed:
        window = F.window("arrival_time", "12 seconds", "6 seconds")
        best = legs.groupBy(*by_leg(), window).agg(least_delayed().alias("best")).select("best.*").distinct()
    else:
        best = best_legs(legs)
        (sort,), splits = sort_and_splits(best)
        assert re.search(r"Sort \[\w+#\d+L ", sort) and splits == 1
    expected = best_legs(timed_legs(flights(random_flights(23))))
    assert set(best.collect()) == set(expected.collect())


@pytest.mark.parametrize("line", [None, "", "\t\t", "2008\t2008-01-01\t2008-01-01T07:00:00.000Z"])
def test_every_line_is_one_record(spark, line):
    got = flights_from_lines(spark.createDataFrame([(line,)], "value string")).collect()
    assert len(got) == 1 and got[0]["origin"] is None and got[0]["arr_delay"] is None
