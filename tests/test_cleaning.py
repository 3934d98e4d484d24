from __future__ import annotations

import datetime as dt

import pytest

from skyledger import schemas
from skyledger.plans import cleaning
from skyledger.session import shared_dir
from skyledger.sinks import files as sinks
from skyledger.sources import files as sources


def export_line(columns, **values):
    return ",".join(f'"{values.get(c, "")}"' for c in columns)


def on_time(**values):
    row = {
        "Year": "2008", "DayOfWeek": "2", "FlightDate": "2008-03-04", "UniqueCarrier": "MQ",
        "FlightNum": "4278", "Origin": "CMI", "OriginCityName": "Champaign, IL", "Dest": "ORD",
        "CRSDepTime": "0710", "DepDelay": "-5.00", "ArrDelay": "-14.00",
    }
    row.update(values)
    return export_line(schemas.ON_TIME_COLUMNS, **row)


@pytest.fixture
def raw(spark, tmp_path):
    header = export_line(schemas.ON_TIME_COLUMNS, **{c: c for c in schemas.ON_TIME_COLUMNS})
    first = [header, on_time(), on_time(FlightNum="2", CRSDepTime="2400"), on_time(FlightNum="3", CRSDepTime="1965")]
    second = [
        header,
        on_time(FlightNum="4", CRSDepTime="1200", DepDelay="", ArrDelay=""),
        on_time(FlightNum="5", Year="1980"),
        on_time(FlightNum="6", Year="1999", FlightDate="1999-12-31", OriginCityName='The ""Windy"" City') + ",",
        on_time(FlightNum="7", CRSDepTime=""),
    ]
    (tmp_path / "a.csv").write_text("\n".join(first) + "\n")
    (tmp_path / "b.csv").write_text("\r\n".join(second) + "\r\n")
    (tmp_path / "c.txt").write_text("ignored by the glob\n")
    return sources.read_on_time_csv(spark, str(tmp_path / "*.csv"))


def test_schema_sizes():
    assert len(schemas.RAW_ON_TIME) == 55
    assert len(schemas.RAW_COUPONS) == 34


def test_clean_on_time(raw):
    rows = {r["flight_num"]: r for r in cleaning.clean_on_time(raw).collect()}
    assert set(rows) == {"4278", "3", "4", "6"}
    best = rows["4278"]
    assert best["flight_date"] == dt.date(2008, 3, 4)
    assert best["flight_datetime"] == dt.datetime(2008, 3, 4, 7, 10)
    assert (best["year"], best["day_of_week"], best["carrier"], best["origin"], best["dest"]) == (
        2008, "2", "MQ", "CMI", "ORD",
    )
    assert (best["dep_delay"], best["arr_delay"]) == (-5.0, -14.0)
    assert rows["3"]["flight_datetime"] is None
    assert (rows["4"]["dep_delay"], rows["4"]["arr_delay"]) == (0.0, 0.0)
    assert rows["4"]["flight_datetime"].hour == 12
    assert rows["6"]["year"] == 1999


def test_columns_are_pruned(raw):
    plan = cleaning.clean_on_time(raw)._jdf.queryExecution().executedPlan().toString()
    assert "OriginCityName" not in plan.split("ReadSchema")[1]


def test_options(raw):
    only = cleaning.clean_on_time(raw, year=2008, valid_clock_only=True)
    assert {r["flight_num"] for r in only.collect()} == {"4278", "4"}


def test_clean_coupons(spark, tmp_path):
    columns = schemas.COUPON_COLUMNS
    lines = [
        export_line(columns, **{c: c for c in columns}),
        export_line(columns, Year="2008", Origin="CMI", Dest="ORD"),
        export_line(columns, Year="1980", Origin="CMI", Dest="ORD"),
    ]
    (tmp_path / "coupons.csv").write_text("\n".join(lines))
    raw = sources.read_coupon_csv(spark, str(tmp_path / "coupons.csv"))
    clean = cleaning.clean_origin_destination(raw)
    assert [tuple(r) for r in clean.collect()] == [(2008, "CMI", "ORD")]


def test_tsv_round_trip(spark, raw, tmp_path):
    clean = cleaning.clean_on_time(raw)
    path = str(tmp_path / "tsv")
    sinks.write_flights_tsv(clean, path)
    sinks.write_flights_tsv(clean, path)  # replaces, does not append
    assert set(sources.read_flights_tsv(spark, path).collect()) == set(clean.collect())
    coupons = clean.select("year", "origin", "dest")
    sinks.write_coupons_tsv(coupons, path)
    assert sorted(sources.read_coupons_tsv(spark, path).collect()) == sorted(coupons.collect())


def test_tsv_text_form(spark, raw, tmp_path):
    path = str(tmp_path / "tsv")
    sinks.write_flights_tsv(cleaning.clean_on_time(raw), path)
    lines = {r["text"] for r in sources.read_text(spark, path).collect()}
    assert (
        "2008\t2008-03-04\t2008-03-04T07:10:00.000Z\t2\tMQ\t4278\tCMI\tORD\t-5.0\t-14.0" in lines
    )


def test_year_folders_are_pruned(spark, raw, tmp_path):
    path = str(tmp_path / "flights")
    sinks.write_flights(cleaning.clean_on_time(raw), path)
    one_year = spark.read.schema(schemas.FLIGHTS).parquet(path).where("year = 1999")
    assert "PartitionFilters: [isnotnull(year" in one_year._jdf.queryExecution().executedPlan().toString()
    assert one_year.count() == 1


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
