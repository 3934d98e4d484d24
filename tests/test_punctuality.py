from __future__ import annotations

from conftest import flight

from skyledger.plans import punctuality


def test_weekday_delay_best_first(flights):
    rows = [flight("2008-01-07T08:00", arr=4), flight("2008-01-14T08:00", arr=-2), flight("2008-01-08T08:00", arr=0)]
    got = [tuple(r) for r in punctuality.weekday_delay(flights(rows)).collect()]
    assert got == [("2", 0.0), ("1", 1.0)]


def carriers(n):
    # Delays fall, so later names are better; two rows each, to need a mean.
    rows = []
    for i in range(n):
        for delta in (-1, 1):
            rows.append(flight("2008-01-07T08:00", carrier=f"C{i:02d}", origin="BIG", dep=20 - i + delta))
    return rows


def test_top_carriers_keeps_ten(flights):
    rows = carriers(13) + [flight("2008-01-07T08:00", carrier="XX", origin="TINY", dep=3)]
    got = punctuality.top_carriers(flights(rows)).collect()
    big = sorted((r["rank"], r["carrier"], r["avg_delay"]) for r in got if r["origin"] == "BIG")
    assert big == [(i + 1, f"C{12 - i:02d}", 8.0 + i) for i in range(10)]
    assert [(r["rank"], r["carrier"]) for r in got if r["origin"] == "TINY"] == [(1, "XX")]


def test_ties_fall_to_the_name(flights):
    rows = [flight("2008-01-07T08:00", dest=d, dep=1) for d in ("CCC", "AAA", "BBB")]
    got = punctuality.top_destinations(flights(rows)).orderBy("rank").collect()
    assert [r["dest"] for r in got] == ["AAA", "BBB", "CCC"]


def test_map_side_limit(flights):
    plan = punctuality.top_carriers(flights(carriers(3)))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_list_and_wide_forms(flights):
    best = punctuality.top_carriers(flights(carriers(11)))
    listed = punctuality.as_name_list(best, "carrier", "carriers").first()
    assert listed["carriers"] == "{" + ",".join(f"(C{i:02d})" for i in range(10, 0, -1)) + "}"
    wide = punctuality.as_wide_list(best.where("rank <= 2"), "carrier", "c").first()
    assert wide["airport"] == "BIG"
    assert (wide["c01"], wide["c02"]) == ("(C10, 10.0)", "(C09, 11.0)")
    assert {wide[f"c{i:02d}"] for i in range(3, 11)} == {"None"}


def test_mean_arrival_delay(flights):
    rows = [flight("2008-01-07T08:00", arr=a) for a in (-3, 0, 9)]
    assert [tuple(r) for r in punctuality.mean_arrival_delay(flights(rows)).collect()] == [("AAA", "BBB", 2.0)]
