from __future__ import annotations

import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyledger import schemas  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("skyledger-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def flight(when: str, carrier="AA", num="1", origin="AAA", dest="BBB", arr=0.0, dep=0.0):
    moment = dt.datetime.fromisoformat(when)
    return (
        moment.year, moment.date(), moment, str(moment.isoweekday()),
        carrier, num, origin, dest, float(dep), float(arr),
    )


@pytest.fixture
def flights(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.FLIGHTS)

    return make


# Known two-leg trips, each as (route, first leg, second leg).
GOLDEN = [
    (("CMI", "ORD", "LAX"), ("2008-03-04T07:10", "MQ", "4278", -14), ("2008-03-06T19:50", "AA", "607", -24)),
    (("JAX", "DFW", "CRP"), ("2008-09-09T07:25", "AA", "845", 1), ("2008-09-11T16:45", "MQ", "3627", -7)),
    (("SLC", "BFL", "LAX"), ("2008-04-01T11:00", "OO", "3755", 12), ("2008-04-03T14:55", "OO", "5429", 6)),
    (("LAX", "SFO", "PHX"), ("2008-07-12T06:50", "WN", "3534", -13), ("2008-07-14T19:25", "US", "412", -19)),
    (("DFW", "ORD", "DFW"), ("2008-06-10T07:00", "UA", "1104", -21), ("2008-06-12T16:45", "AA", "2341", -10)),
    (("LAX", "ORD", "JFK"), ("2008-01-01T06:00", "UA", "618", 0), ("2008-01-03T19:00", "B6", "918", -7)),
]


def golden_flights():
    rows = []
    for (x, y, z), (t1, c1, f1, a1), (t2, c2, f2, a2) in GOLDEN:
        rows.append(flight(t1, c1, f1, x, y, arr=a1))
        rows.append(flight(t2, c2, f2, y, z, arr=a2))
    return rows


def random_flights(seed: int, n: int = 600):
    """Few airports, dates and delays, so that legs tie and combine often."""
    import random

    pick = random.Random(seed)
    airports = ["AAA", "BBB", "CCC", "DDD"]
    rows = []
    for i in range(n):
        origin, dest = pick.choice(airports), pick.choice(airports)
        when = f"2008-01-{pick.randint(1, 6):02d}T{pick.randint(0, 23):02d}:{pick.choice([0, 30]):02d}"
        rows.append(
            flight(when, pick.choice(["AA", "UA", "DL"]), str(i), origin, dest,
                   arr=pick.randint(-3, 3), dep=pick.randint(-3, 3))
        )
    return rows


def brute_trips(rows, pm_from_hour: int = 12):
    """Every pair of best legs, by plain loops."""
    best = {}
    for r in rows:
        hour = r[2].hour
        if 12 <= hour < pm_from_hour:
            continue
        key = ("am" if hour < 12 else "pm", r[6], r[7], r[1])
        rank = (r[9], r[2], r[4], r[5])
        if key not in best or rank < best[key]:
            best[key] = rank
    found = set()
    for (leg, x, y, day), (a1, t1, c1, f1) in best.items():
        if leg != "am":
            continue
        for (leg2, y2, z, day2), (a2, t2, c2, f2) in best.items():
            if leg2 == "pm" and y2 == y and (day2 - day).days == 2:
                found.add((day, t1, c1, f1, x, y, a1, day2, t2, c2, f2, z, a2))
    return found
