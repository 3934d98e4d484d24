"""Check SQL for the registered queries, over the same Parquet tables."""

from __future__ import annotations

from skyledger.catalog.queries import LOOKUP, TRIP_YEAR

_RAW = """raw AS (
  SELECT
    CAST(2007 + l_linenumber % 2 AS INT) AS year,
    CAST(make_date(CAST(2007 + l_linenumber % 2 AS INT), 1, 1)
         + CAST(l_partkey % 40 AS INT) AS DATE) AS flight_date,
    CASE WHEN l_linenumber = 6 AND l_orderkey % 50 = 0 THEN '2400'
         ELSE lpad(CAST((l_orderkey * 7 + l_linenumber * 5) % 24 AS VARCHAR), 2, '0')
              || lpad(CAST((l_partkey % 12) * 5 AS VARCHAR), 2, '0') END AS crs_dep_time,
    'C' || lpad(CAST((l_partkey + l_suppkey) % 20 AS VARCHAR), 2, '0') AS carrier,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
      || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS flight_num,
    'A' || lpad(CAST(l_suppkey % 40 AS VARCHAR), 2, '0') AS origin,
    'A' || lpad(CAST(3 + o_custkey % 42 AS VARCHAR), 2, '0') AS dest,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS INT) - 15 END AS dep_delay,
    CASE WHEN l_linenumber = 7 THEN NULL
         ELSE CAST(l_quantity AS INT) - 20 + CAST(l_orderkey % 9 AS INT) END AS arr_delay,
    CAST(l_orderkey % 120 AS INT) AS arrival_s
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_CLEAN = _RAW + """, clean AS (
  SELECT year, flight_date,
    strptime(CAST(flight_date AS VARCHAR) || ' ' || crs_dep_time, '%Y-%m-%d %H%M') AS flight_datetime,
    CAST(extract(isodow FROM flight_date) AS VARCHAR) AS day_of_week,
    carrier, flight_num, origin, dest,
    CAST(coalesce(dep_delay, 0) AS DOUBLE) AS dep_delay,
    CAST(coalesce(arr_delay, 0) AS DOUBLE) AS arr_delay,
    arrival_s
  FROM raw WHERE year > 1980 AND CAST(crs_dep_time AS INT) < 2400
)"""

# The same with spoilt years and readings.
_BAD = _RAW + """, bad AS (
  SELECT * REPLACE (
    CASE WHEN arrival_s = 7 THEN 1980 WHEN arrival_s <> 11 THEN year END AS year,
    CASE WHEN arrival_s = 13 THEN '1965' ELSE crs_dep_time END AS crs_dep_time)
  FROM raw
), clean AS (
  SELECT year, flight_date,
    CASE WHEN crs_dep_time <> '1965'
         THEN try_strptime(CAST(flight_date AS VARCHAR) || ' ' || crs_dep_time, '%Y-%m-%d %H%M') END AS flight_datetime,
    CAST(extract(isodow FROM flight_date) AS VARCHAR) AS day_of_week,
    carrier, flight_num, origin, dest,
    CAST(coalesce(dep_delay, 0) AS DOUBLE) AS dep_delay,
    CAST(coalesce(arr_delay, 0) AS DOUBLE) AS arr_delay
  FROM bad WHERE year > 1980 AND CAST(crs_dep_time AS INT) < 2400
)"""

_FLIGHT_COLUMNS = (
    "year, flight_date, flight_datetime, day_of_week, carrier, flight_num, "
    "origin, dest, dep_delay, arr_delay"
)

_COUPONS = _RAW + ", coupons AS (SELECT year, origin, dest FROM raw WHERE year > 1980)"

_TOTALS = _COUPONS + """, departures AS (
  SELECT origin AS airport, count(year) AS n FROM coupons GROUP BY origin
), arrivals AS (
  SELECT dest AS airport, count(year) AS n FROM coupons GROUP BY dest
), totals AS (
  SELECT d.airport, d.n + a.n AS total
  FROM departures d LEFT JOIN arrivals a ON d.airport = a.airport
)"""

# Streams count every airport, those with arrivals only included.
_TOUCHED = """, touched AS (
  SELECT airport, count(*) AS total
  FROM (SELECT origin AS airport FROM {source} UNION ALL SELECT dest FROM {source})
  GROUP BY airport
)"""


def _best(name: str) -> str:
    return _CLEAN + f""", means AS (
  SELECT origin, {name}, avg(dep_delay) AS avg_delay FROM clean GROUP BY origin, {name}
), best AS (
  SELECT origin, rank, {name}, avg_delay FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY origin ORDER BY avg_delay, {name}) AS INT) AS rank
    FROM means)
  WHERE rank <= 10
)"""


def _name_list(name: str, column: str) -> str:
    return f"""WITH {_best(name)}
SELECT origin AS airport,
  '{{' || string_agg('(' || {name} || ')', ',' ORDER BY rank) || '}}' AS {column}
FROM best GROUP BY origin"""


def _wide(name: str, prefix: str) -> str:
    cells = ",\n  ".join(
        f"coalesce(max(CASE WHEN rank = {i} THEN '(' || {name} || ', ' || "
        f"CAST(avg_delay AS VARCHAR) || ')' END), 'None') AS {prefix}{i:02d}"
        for i in range(1, 11)
    )
    return f"WITH {_best(name)}\nSELECT origin AS airport,\n  {cells}\nFROM best GROUP BY origin"


def _legs(pm_from_hour: int = 12, window: bool = False) -> str:
    extra = "window_start, " if window else ""
    source = (
        "(SELECT *, CAST(1704067200 + (arrival_s // 6) * 6 AS BIGINT) AS window_start FROM clean "
        "UNION ALL "
        "SELECT *, CAST(1704067200 + (arrival_s // 6) * 6 - 6 AS BIGINT) AS window_start FROM clean)"
        if window
        else "clean"
    )
    return _CLEAN + f""", timed AS (
  SELECT *, CASE WHEN extract(hour FROM flight_datetime) < 12 THEN 'am' ELSE 'pm' END AS leg
  FROM {source}
  WHERE year = {TRIP_YEAR}
    AND (extract(hour FROM flight_datetime) < 12 OR extract(hour FROM flight_datetime) >= {pm_from_hour})
), legs AS (
  SELECT {extra}leg, flight_date AS date, flight_datetime AS date_time, carrier,
    flight_num AS flight, origin, dest AS destination, arr_delay AS arrival_delay
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {extra}leg, origin, dest, flight_date
      ORDER BY arr_delay, flight_datetime, carrier, flight_num) AS rn
    FROM timed)
  WHERE rn = 1
)"""


def _trips(pm_from_hour: int = 12, window: bool = False) -> str:
    same_window = " AND a.window_start = p.window_start" if window else ""
    extra = ", a.window_start" if window else ""
    return _legs(pm_from_hour, window) + f""", trips AS (
  SELECT a.date AS origin_date, a.date_time AS origin_date_time, a.carrier AS origin_carrier,
    a.flight AS origin_flight, a.origin AS origin, a.destination AS connection,
    a.arrival_delay AS connection_arr_delay, p.date AS connection_date,
    p.date_time AS connection_date_time, p.carrier AS connection_carrier,
    p.flight AS connection_flight, p.destination AS destination,
    p.arrival_delay AS destination_arr_delay{extra}
  FROM legs a JOIN legs p
    ON a.leg = 'am' AND p.leg = 'pm' AND a.destination = p.origin
   AND p.date = a.date + 2{same_window}
)"""


_FLIGHTS_SQL = f"WITH {_CLEAN}\nSELECT {_FLIGHT_COLUMNS} FROM clean"
_FLIGHTS_YEAR_SQL = f"{_FLIGHTS_SQL} WHERE year = {TRIP_YEAR}"
_COUPONS_SQL = f"WITH {_COUPONS}\nSELECT year, origin, dest FROM coupons"
_MEAN_SQL = f"""WITH {_CLEAN}
SELECT origin, dest AS destination, avg(arr_delay) AS mean_delay FROM clean GROUP BY origin, dest"""
_TRIPS_SQL = f"WITH {_trips()}\nSELECT * FROM trips"
_RANK_SQL = f"""WITH {_TOTALS}, ranked AS (
  SELECT CAST(rank() OVER (ORDER BY total DESC NULLS LAST) AS BIGINT) AS rank, total FROM totals
)
"""
_STORED_LEG = "date, date_time, carrier, flight, origin, destination, arrival_delay"


# Each step once, as the windows double the records.
_WINDOWED = _trips(window=True)
for _name in ("raw", "clean", "timed", "legs"):
    _WINDOWED = _WINDOWED.replace(f"{_name} AS (", f"{_name} AS MATERIALIZED (", 1)
_WINDOWED_SQL = f"WITH {_WINDOWED}\nSELECT * FROM trips"


def oracle_sql() -> dict[str, str]:
    carriers = f"WITH {_best('carrier')}\nSELECT * FROM best"
    destinations = f"WITH {_best('dest')}\nSELECT * FROM best"
    weekdays = (
        f"WITH {_CLEAN}\nSELECT day_of_week, {{extra}}avg(arr_delay) AS avg_delay "
        "FROM clean GROUP BY day_of_week"
    )
    day_name = (
        "CASE day_of_week WHEN '1' THEN 'Monday' WHEN '2' THEN 'Tuesday' "
        "WHEN '3' THEN 'Wednesday' WHEN '4' THEN 'Thursday' WHEN '5' THEN 'Friday' "
        "WHEN '6' THEN 'Saturday' WHEN '7' THEN 'Sunday' END AS day_name, "
    )
    top = "SELECT CAST(row_number() OVER (ORDER BY total DESC NULLS LAST, airport) AS INT) AS place, airport, total FROM {t} ORDER BY place LIMIT 10"
    words = """SELECT word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word"""
    legs_at = f"""WITH {_legs()}
SELECT {_STORED_LEG} FROM legs WHERE leg = 'am' AND destination = '{LOOKUP["connection"]}'
  AND date = DATE '{LOOKUP["origin_date"]}'"""
    touched_clean = _CLEAN + _TOUCHED.format(source="clean")
    touched_coupons = _COUPONS + _TOUCHED.format(source="coupons")
    return {
        "clean_on_time": _FLIGHTS_SQL,
        "clean_on_time_2008": _FLIGHTS_YEAR_SQL,
        "clean_origin_destination": _COUPONS_SQL,
        "csv_clean_on_time": _FLIGHTS_SQL,
        "csv_clean_origin_destination": _COUPONS_SQL,
        "tsv_clean_on_time": _FLIGHTS_SQL,
        "tsv_clean_origin_destination": _COUPONS_SQL,
        "flights_by_year": _FLIGHTS_YEAR_SQL,
        "zip_ingest": _FLIGHTS_SQL,
        "zip_records": f"""WITH {_RAW}, told AS (
  SELECT flight_num LIKE '%33' AS broken, arr_delay,
    CASE WHEN flight_num LIKE '%33' THEN origin || ',"' || flight_num
         WHEN flight_num LIKE '%7' THEN origin || chr(10) || '"twin", ' || dest ELSE origin END AS content
  FROM raw
)
SELECT broken, content, count(*) AS n, CAST(sum(CASE WHEN NOT broken THEN arr_delay END) AS DOUBLE) AS delay
FROM told GROUP BY broken, content""",
        "clean_bad_rows": f"WITH {_BAD}\nSELECT {_FLIGHT_COLUMNS} FROM clean",
        "valid_clock_only": f"WITH {_BAD}\nSELECT {_FLIGHT_COLUMNS} FROM clean WHERE flight_datetime IS NOT NULL",
        "word_count_files": words,
        "legs_at_millis": legs_at,
        "top_airports": f"WITH {_TOTALS}\n" + top.format(t="totals"),
        "popularity_rank": _RANK_SQL
        + "SELECT rank, total, round(log10(rank), 9) AS log10_rank, round(log10(total), 9) AS log10_total "
        "FROM ranked WHERE total IS NOT NULL",
        "weekday_delay": weekdays.format(extra=""),
        "top_carriers": carriers,
        "top_destinations": destinations,
        "top_carriers_list": _name_list("carrier", "carriers"),
        "top_destinations_list": _name_list("dest", "destinations"),
        "mean_arrival_delay": _MEAN_SQL,
        "trips": _TRIPS_SQL,
        "trips_pm13": f"WITH {_trips(13)}\nSELECT * FROM trips",
        "trips_text": f"""WITH {_trips()}
SELECT * REPLACE (
  strftime(origin_date, '%Y-%m-%d') AS origin_date,
  strftime(origin_date_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS origin_date_time,
  strftime(connection_date, '%Y-%m-%d') AS connection_date,
  strftime(connection_date_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS connection_date_time)
FROM trips""",
        "trips_millis": f"""WITH {_trips()}
SELECT * REPLACE (
  epoch_ms(CAST(origin_date AS TIMESTAMP)) AS origin_date,
  epoch_ms(origin_date_time) AS origin_date_time,
  epoch_ms(CAST(connection_date AS TIMESTAMP)) AS connection_date,
  epoch_ms(connection_date_time) AS connection_date_time)
FROM trips""",
        "best_legs_millis": f"""WITH {_legs()}
SELECT epoch_ms(CAST(date AS TIMESTAMP)) AS date, epoch_ms(date_time) AS date_time,
  carrier, flight, origin, destination, arrival_delay FROM legs""",
        "trip_lookup": f"""WITH {_trips()}
SELECT * FROM trips WHERE origin = '{LOOKUP["origin"]}' AND connection = '{LOOKUP["connection"]}'
  AND destination = '{LOOKUP["destination"]}' AND origin_date = DATE '{LOOKUP["origin_date"]}'""",
        "stored_mean_delays": _MEAN_SQL,
        "stored_popularity": _RANK_SQL + "SELECT rank, total FROM ranked WHERE total IS NOT NULL",
        "stored_trips": _TRIPS_SQL,
        "quoted_totals": f"""WITH {touched_coupons}
SELECT '"' || airport || '","' || CAST(total AS VARCHAR) || '"' AS line FROM touched""",
        "word_count": words,
        "stream_top_airports": f"WITH {touched_clean}\n" + top.format(t="touched"),
        "stream_top_airports_timed": f"WITH {touched_clean}\n" + top.format(t="touched"),
        "stream_popularity_index": f"""WITH {touched_clean}
SELECT row_number() OVER (ORDER BY total DESC, airport) - 1 AS index, total FROM touched""",
        "stream_weekday_delay": weekdays.format(extra=day_name),
        "stream_mean_arrival_delay": _MEAN_SQL,
        "stream_mean_arrival_backfilled": _MEAN_SQL,
        "stream_top_carriers": carriers,
        "stream_top_carriers_wide": _wide("carrier", "c"),
        "stream_top_destinations": destinations,
        "stream_top_destinations_wide": _wide("dest", "d"),
        "stream_trips_incremental": _TRIPS_SQL,
        "stream_trip_origins": f"WITH {_legs()}\nSELECT {_STORED_LEG} FROM legs WHERE leg = 'am'",
        "stream_trip_destinations": f"WITH {_legs()}\nSELECT {_STORED_LEG} FROM legs WHERE leg = 'pm'",
        "stream_legs_at": legs_at,
        "stream_trips_restarted": _TRIPS_SQL,
        "stream_trips_windowed": _WINDOWED_SQL,
        "stream_trips_joined": _WINDOWED_SQL,
        "stream_record_count": f"WITH {_CLEAN}\nSELECT count(*) AS n FROM clean",
        "replay_files": _FLIGHTS_SQL,
    }
