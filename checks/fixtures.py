"""Tap, visit and schedule relations derived from the test tables.

The same SQL text runs in Spark and in DuckDB. It reads the whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tapweave import Settings
from tapweave.config import tune
from tapweave.plans.prepare import Prepared, prepare


def _clock(seconds: str) -> str:
    def part(expression: str) -> str:
        return f"lpad(CAST(CAST({expression} AS int) AS varchar(9)), 2, '0')"

    h = part(f"floor(({seconds}) / 3600)")
    m = part(f"floor((({seconds}) % 3600) / 60)")
    s = part(f"({seconds}) % 60")
    return f"concat({h}, ':', {m}, ':', {s})"


FIXTURE_SQL = {
    "fx_visits": """
SELECT tk AS trip_id, seq AS stop_sequence, CAST(l_suppkey % 16 + 1 AS int) AS stop_no,
       make_date(2024, 1, CAST(1 + tk % 30 AS int)) AS service_date,
       CAST((CAST(floor(tk / 30) AS bigint) * 397) % 72000 + 14400 + (seq - 1) * 300 AS bigint) AS arr_s,
       CAST(CASE WHEN seq % 5 = 0 THEN 0 ELSE 30 END AS bigint) AS dwell_s
FROM (SELECT l_suppkey, CAST(floor(l_orderkey / 5) AS bigint) AS tk,
             row_number() OVER (PARTITION BY CAST(floor(l_orderkey / 5) AS bigint)
               ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, l_extendedprice) AS seq
      FROM lineitem) x""",
    "fx_stop_events": f"""
SELECT CAST(trip_id AS int) AS trip_id, CAST(stop_no AS varchar(9)) AS stop_id,
       CAST(stop_sequence AS int) AS stop_sequence,
       {_clock('arr_s')} AS actual_arrive_time, {_clock('arr_s + dwell_s')} AS actual_departure_time, service_date
FROM fx_visits""",
    "fx_trips": """
SELECT DISTINCT CAST(trip_id AS int) AS trip_id,
       CASE CAST(floor(trip_id / 7) AS bigint) % 5 WHEN 0 THEN '100' WHEN 1 THEN '90' WHEN 2 THEN '4'
            WHEN 3 THEN '72' ELSE '81a' END AS route_id,
       'A' AS service_id, CAST(trip_id % 2 AS int) AS direction_id,
       CAST(CAST(floor(trip_id / 30) AS bigint) % 3 AS int) AS block_id
FROM fx_visits""",
    "fx_stops": """
SELECT DISTINCT stop_no AS stop_id,
       CAST(45.4 + CAST(floor(stop_no / 2) AS int) * 0.005 + (stop_no % 2) * 0.001 + r.d AS double) AS stop_lat,
       CAST(-122.8 + (stop_no % 4) * 0.0005 AS double) AS stop_lon, r.release_date
FROM fx_visits CROSS JOIN (SELECT make_date(2023, 12, 15) AS release_date, 0.0 AS d
                           UNION ALL SELECT make_date(2024, 1, 16), 0.0001) r""",
    "fx_taps": """
SELECT event_id, concat('C', CAST(user_id AS varchar(19))) AS card_id,
       substr(CAST(ts AS varchar(30)), 1, 19) AS tap_time, CAST(ts AS date) AS service_date,
       CASE event_type WHEN 'click' THEN 200 WHEN 'view' THEN 200 WHEN 'error' THEN 4
            WHEN 'purchase' THEN 72 ELSE 81 END AS line_id,
       CAST(CASE WHEN event_id % 53 = 0 THEN -1 ELSE (event_id * 7) % 16 + 1 END AS int) AS stop_id,
       CAST(event_id % 2 AS int) AS direction_id,
       CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'OTHER'
            ELSE 'MAIN' END AS operatedby_description,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE 'Stored value' END AS transaction_ticket_description,
       CASE WHEN event_id % 3 = 0 THEN 'Youth' ELSE 'Adult' END AS fare_category_description
FROM events""",
    "fx_calendar": """
SELECT route_id AS service_id,
       CAST(year(min(service_date)) * 10000 + month(min(service_date)) * 100 + day(min(service_date)) AS int)
         AS start_date,
       CAST(year(max(service_date)) * 10000 + month(max(service_date)) * 100 + day(max(service_date)) AS int)
         AS end_date
FROM fx_visits JOIN fx_trips USING (trip_id) GROUP BY route_id""",
    "fx_calendar_dates": """
SELECT 'A' AS service_id, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS int) AS date, 1 AS exception_type
FROM (SELECT DISTINCT service_date AS d FROM fx_visits) x
UNION ALL SELECT 'B', CAST(year(d) * 10000 + month(d) * 100 + day(d) AS int), 2
FROM (SELECT min(service_date) AS d FROM fx_visits) y""",
    "fx_stop_times": """
SELECT trip_id, actual_arrive_time AS arrival_time, actual_departure_time AS departure_time,
       CAST(stop_id AS int) AS stop_id, stop_sequence
FROM fx_stop_events""",
}

# Fixture values of the settings; everything else is the default.
FIXTURE_SETTINGS = Settings(unwanted_operators=("OTHER",))


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    with_list = ",\n".join(f"{key} AS ({sql})" for key, sql in FIXTURE_SQL.items())
    text = f"WITH {with_list}\nSELECT * FROM {name}"
    return spark.sql(re.sub(r"\bFROM (lineitem|events)\b", rf"FROM parquet.`{sf_dir}/\1.parquet`", text))


def raw_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return tuple(fixture(spark, sf_dir, n) for n in ("fx_taps", "fx_stop_events", "fx_trips", "fx_stops"))


def prepared_tables(
    spark: SparkSession, sf_dir: str, settings: Settings = FIXTURE_SETTINGS, strict: bool = False
) -> Prepared:
    return prepare(*raw_tables(spark, sf_dir), settings, strict)
