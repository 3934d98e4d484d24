from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import flight
from skyledger import schemas
from skyledger.operators import ranking
from skyledger.operators.traffic import airport_totals, endpoint_counts
from skyledger.plans import popularity, wordcount


@pytest.fixture
def coupons(spark):
    rows = (
        [(2008, "HUB", "AAA")] * 40
        + [(2008, "AAA", "HUB")] * 30
        + [(2008, "OUT", "HUB")] * 5  # departures only
        + [(2008, "HUB", "INN")] * 7  # arrivals only
        + [(None, "AAA", "HUB")] * 3  # no year, not counted
        + [(2008, None, "HUB"), (2008, "HUB", None)]
    )
    return spark.createDataFrame(rows, schemas.COUPONS)


def test_totals_follow_a_left_join(coupons):
    got = {r["airport"]: r["total"] for r in airport_totals(coupons).collect()}
    assert got == {"HUB": 48 + 36, "AAA": 70, "OUT": None, None: None}


def test_totals_against_an_explicit_join(coupons):
    departures = coupons.groupBy(F.col("origin").alias("airport")).agg(F.count("year").alias("d"))
    arrivals = coupons.groupBy(F.col("dest").alias("airport")).agg(F.count("year").alias("a"))
    joined = departures.join(arrivals, "airport", "left").select("airport", (F.col("d") + F.col("a")).alias("total"))
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, airport_totals(coupons).collect()))


def test_input_is_scanned_once(spark, tmp_path, coupons):
    coupons.write.parquet(str(tmp_path / "c"))
    plan = airport_totals(spark.read.schema(schemas.COUPONS).parquet(str(tmp_path / "c")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Join" not in text


def test_top_airports(coupons):
    got = [tuple(r) for r in popularity.top_airports(coupons, 3).orderBy("place").collect()]
    assert got == [(1, "HUB", 84), (2, "AAA", 70), (3, "OUT", None)]


def test_top_airports_breaks_ties_by_name(spark):
    rows = [(2008, a, b) for a, b in [("B", "C"), ("C", "A"), ("A", "B")]]
    got = popularity.top_airports(spark.createDataFrame(rows, schemas.COUPONS), 2)
    assert [r["airport"] for r in got.orderBy("place").collect()] == ["A", "B"]


def test_popularity_rank_drops_unknown_totals(coupons):
    got = sorted(tuple(r)[:2] for r in popularity.popularity_rank(coupons).collect())
    assert got == [(1, 84), (2, 70)]


def test_log_columns(coupons):
    first = popularity.popularity_rank(coupons).where("rank = 1").first()
    assert first["log10_rank"] == 0.0
    assert first["log10_total"] == pytest.approx(1.924279286)


def test_endpoint_counts_hold_every_airport(coupons):
    got = {r["airport"]: r["total"] for r in endpoint_counts(coupons).collect()}
    assert got["INN"] == 7 and got["OUT"] == 5


def brute_numbers(totals):
    ordered = sorted((t for t in totals if t is not None), reverse=True)
    return [(i, ordered.index(t) + 1, t) for i, t in enumerate(ordered)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=40))
def test_numbering_matches_brute_force(spark, totals):
    frame = spark.createDataFrame([(t,) for t in totals], "total bigint")
    got = sorted(tuple(r) for r in ranking.number_by_total(frame).collect())
    assert got == brute_numbers(totals)


def test_long_run_of_equal_totals(spark):
    frame = spark.range(5000).select(F.when(F.col("id") < 10, 9).otherwise(1).cast("bigint").alias("total"))
    rows = ranking.number_by_total(frame)
    assert rows.count() == 5000
    assert rows.agg(F.countDistinct("position"), F.max("position")).first()[:] == (5000, 4999)
    assert {tuple(r) for r in rows.select("rank", "total").distinct().collect()} == {(1, 9), (11, 1)}


def test_word_count_matches_brute_force(spark):
    lines = ["to be  or\tnot", "", "  to\x0cbe\r\nto ", None, "é é"]
    expected = Counter()
    for line in lines:
        for gap in "\t\n\r\x0c":
            line = (line or "").replace(gap, " ")
        expected.update(w for w in line.split(" ") if w)
    frame = spark.createDataFrame([(line,) for line in lines], "text string")
    assert {r["word"]: r["n"] for r in wordcount.word_count(frame).collect()} == dict(expected)


def test_a_record_without_airports_touches_none(flights):
    rows = [flight("2008-03-04T07:00", origin="AAA", dest="BBB"), flight("2008-03-04T07:00", origin=None, dest="BBB")]
    counted = {r["airport"]: r["total"] for r in endpoint_counts(flights(rows)).collect()}
    assert counted == {"AAA": 1, "BBB": 2}
