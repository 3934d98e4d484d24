from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyledger.functions import clock, texts


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("0710", dt.datetime(2008, 3, 4, 7, 10)),
        ("710", dt.datetime(2008, 3, 4, 7, 10)),
        ("0000", dt.datetime(2008, 3, 4)),
        ("2359", dt.datetime(2008, 3, 4, 23, 59)),
        ("1965", None),
        ("2400", None),
        ("ab12", None),
        (None, None),
    ],
)
def test_departure(spark, text, expected):
    date = F.lit("2008-03-04").cast("date")
    assert one(spark, clock.departure_datetime(date, F.lit(text).cast("string"))) == expected


def test_departure_accepts_text_dates(spark):
    got = one(spark, clock.departure_datetime(F.lit("2008-03-04"), F.lit("0710")))
    assert got == dt.datetime(2008, 3, 4, 7, 10)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_moments_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on this day.
        moment = clock.departure_datetime(F.lit("2008-03-09"), F.lit("0230"))
        assert one(spark, clock.iso_datetime(moment)) == "2008-03-09T02:30:00.000000Z"
        assert one(spark, clock.epoch_millis(moment)) == 1205029800000
        back = clock.from_epoch_millis(F.lit(1205029800000))
        assert one(spark, back) == dt.datetime(2008, 3, 9, 2, 30)
        parsed = clock.parse_iso_datetime(F.lit("2008-03-09T02:30:00.000Z"))
        assert one(spark, parsed) == dt.datetime(2008, 3, 9, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_date_in_millis(spark):
    assert one(spark, clock.epoch_millis(F.lit("2008-01-01").cast("date"))) == 1199145600000


def test_half_days_and_noon_gap(spark):
    def at(hhmm):
        return clock.departure_datetime(F.lit("2008-01-01"), F.lit(hhmm))

    assert one(spark, clock.half_of_day(at("1159"))) == "am"
    assert one(spark, clock.half_of_day(at("1200"))) == "pm"
    assert one(spark, clock.half_of_day(at("1965"))) is None
    assert one(spark, clock.outside_noon_gap(at("1259"), 12)) is True
    assert one(spark, clock.outside_noon_gap(at("1259"), 13)) is False
    assert one(spark, clock.outside_noon_gap(at("1300"), 13)) is True
    assert one(spark, clock.outside_noon_gap(at("1159"), 13)) is True


def test_text_helpers(spark):
    assert one(spark, texts.tab_field(F.lit("a\tb\tc"), 1)) == "b"
    assert one(spark, texts.tab_field(F.lit("a\tb"), 5)) is None
    assert one(spark, texts.weekday_name(F.lit("1"))) == "Monday"
    assert one(spark, texts.weekday_name(F.lit("7"))) == "Sunday"
    assert one(spark, texts.weekday_name(F.lit("9"))) is None
    assert one(spark, texts.weekday_name(F.lit("x"))) is None
    assert one(spark, texts.quoted_line(F.lit("ORD"), F.lit(3))) == '"ORD","3"'
    assert one(spark, texts.quoted_line(F.lit("ORD"), F.lit(None).cast("int"))) == '"ORD","None"'
    assert one(spark, texts.pair_text(F.lit("O'Hare"), F.lit(-1.5))) == "(OHare, -1.5)"
    assert one(spark, texts.bag_text(F.array(F.lit("AA"), F.lit("DL")))) == "{(AA),(DL)}"
