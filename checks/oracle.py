"""The same results as plain SQL, for comparison in DuckDB.

Each step is a named table expression. The steps use the direct form of every
operator (range joins with ranking, recursive chains) and none of the forms
the package uses for scale.
"""

from __future__ import annotations

import re

from checks.fixtures import FIXTURE_SQL


def meters(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    return (
        f"(2 * 6371000 * asin(sqrt(pow(sin((radians({lat_a}) - radians({lat_b})) / 2), 2) + cos(radians({lat_a}))"
        f" * cos(radians({lat_b})) * pow(sin((radians({lon_a}) - radians({lon_b})) / 2), 2))))"
    )


def alias_line(column: str) -> str:
    return (
        f"CASE WHEN {column} IN (290, 90, 100, 190, 203) THEN 200"
        f" WHEN {column} IN (194, 195, 196) THEN 193 ELSE {column} END"
    )


def _clock(date: str, text: str) -> str:
    part = [f"CAST(split_part({text}, ':', {i}) AS bigint)" for i in (1, 2, 3)]
    return f"(CAST(epoch(CAST({date} AS timestamp)) AS bigint) + {part[0]} * 3600 + {part[1]} * 60 + {part[2]})"


_NEXT = ", ".join(
    f"lead({c}) OVER w AS {c}_next"
    for c in ("tap_s", "service_date", "line_id", "stop_id", "stop_lat", "stop_lon", "direction_id")
)
_PREFER = (
    "alight_s ASC NULLS FIRST, run_id ASC NULLS FIRST, board_sequence ASC NULLS FIRST,"
    " alight_sequence ASC NULLS FIRST, stop_id ASC NULLS FIRST"
)
_EVENT_ORDER = (
    "dt_s, CASE event WHEN 'ALIGHTED' THEN 1 WHEN 'BOARDED' THEN 2 WHEN 'INTERLINE_STARTED' THEN 3 ELSE 4 END,"
    " stop_id, line_id"
)
_FREEZE = "AS MATERIALIZED"


def _runs(allow: bool) -> str:
    chained = "c.interlining_trip_id <> v.trip_id" if allow else "false"
    whole = "c.interlining_trip_id" if allow else "CAST(v.trip_id AS decimal(38,0))"
    return f"""
SELECT service_date, trip_id AS leg_trip_id, run AS trip_id,
       CAST(CASE WHEN run > 9223372036854775807 THEN run - 18446744073709551616 ELSE run END AS bigint) AS run_id,
       stop_id, stop_lat, stop_lon, route_id, route_id_old, direction_id, headway, arr_s,
       CASE WHEN chained AND nx = stop_id THEN ndep ELSE dep_s END AS dep_s,
       CASE WHEN chained AND nx = stop_id THEN 'INTERLINE' ELSE 'SINGLE_LINE' END AS stop_type,
       CASE WHEN chained THEN 'INTERLINE' ELSE 'SINGLE_LINE' END AS trip_type,
       CAST(CASE WHEN chained THEN row_number() OVER (PARTITION BY service_date, run
            ORDER BY arr_s, trip_id, stop_sequence) ELSE stop_sequence END AS int) AS stop_sequence
FROM (SELECT *, lag(stop_id) OVER w AS pv, lead(stop_id) OVER w AS nx, lead(dep_s) OVER w AS ndep
      FROM (SELECT v.*, {whole} AS run, {chained} AS chained
            FROM visits v LEFT JOIN chains c ON c.service_date = v.service_date AND c.trip_id = v.trip_id) x
      WINDOW w AS (PARTITION BY service_date, run ORDER BY arr_s, dep_s, trip_id, stop_sequence)) y
WHERE NOT chained OR pv <> stop_id"""


_SCORES = {
    "board_platform": """
SELECT * EXCLUDE (n, p), p / nullif(sum(p) OVER (PARTITION BY card_id, tap_s, board_route, board_direction_id), 0)
         AS boarding_probability
FROM (SELECT *, (1 - exp(-1.0 / headway)) * exp(-(depart_s - tap_s) / headway) AS p
      FROM platform_options WHERE n <= 2) x""",
    "board_onboard": """
SELECT * EXCLUDE (n, p), p / nullif(sum(p) OVER (PARTITION BY card_id, tap_s), 0) AS boarding_probability
FROM (SELECT *, (1 - exp(-1.0 / headway)) / (1 - exp(-(headway + 1) / headway))
             * exp(-(tap_s - arrive_s) / headway) AS p
      FROM onboard_options WHERE n <= 3) x""",
    "boardings": "SELECT * FROM board_platform UNION ALL BY NAME SELECT * FROM board_onboard",
    "reached": """
SELECT b.*, a.arr_s AS alight_s, a.dep_s AS alight_depart_s, a.stop_id AS alight_stop_id, a.stop_lat AS alight_lat,
       a.stop_lon AS alight_lon, a.stop_sequence AS alight_sequence, a.route_id_old AS alight_route
FROM boardings b LEFT JOIN runs a ON a.service_date = b.service_date AND a.run_id = b.run_id
 AND a.arr_s > b.depart_s AND a.arr_s > b.tap_s AND a.arr_s <= b.next_s""",
    "walked": f"""
SELECT *, sqrt(2) * {meters('alight_lat', 'alight_lon', 'next_lat', 'next_lon')} AS transfer_meters,
       sqrt(2) * {meters('alight_lat', 'alight_lon', 'next_lat', 'next_lon')} / 1.5 AS transfer_seconds,
       sqrt(2) * {meters('stop_lat', 'stop_lon', 'next_lat', 'next_lon')} / 1.5 AS walk_all_seconds
FROM reached""",
    "timed": """
SELECT *, min(travel_seconds) OVER (PARTITION BY card_id, tap_s, run_id) AS min_travel_seconds,
       max(travel_seconds) OVER (PARTITION BY card_id, tap_s, run_id) AS max_travel_seconds
FROM (SELECT *, alight_s - arrive_s + transfer_seconds AS travel_seconds FROM walked) x""",
    "left_off": """
SELECT *, stop_probability * not_left_probability AS alighting_probability
FROM (SELECT *, coalesce(product(1 - stop_probability) OVER (PARTITION BY card_id, tap_s, run_id
                ORDER BY alight_depart_s NULLS FIRST, alight_s NULLS FIRST,
                alight_sequence NULLS FIRST, arrive_s, board_sequence, stop_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS not_left_probability
      FROM (SELECT *, CASE WHEN alight_s <> alight_depart_s
                      THEN g * g / nullif(t * t + g * g, 0) ELSE 0 END AS stop_probability
            FROM (SELECT *, travel_seconds - min_travel_seconds AS t,
                         0.5 / nullif(max_travel_seconds - min_travel_seconds, 0) AS g FROM timed) x) y) z""",
    "confident": """
SELECT * EXCLUDE (u, us, pl),
       CASE WHEN line_id = 200 THEN alighting_probability * boarding_probability * (u / nullif(us, 0))
            ELSE alighting_probability * boarding_probability END AS confidence
FROM (SELECT *, sum(CASE WHEN pl = 1 THEN u END) OVER (PARTITION BY card_id, tap_s) AS us
      FROM (SELECT *, exp(min(min_travel_seconds) OVER (PARTITION BY card_id, tap_s)
                   / nullif(min(min_travel_seconds) OVER (PARTITION BY card_id, tap_s, board_route, board_direction_id), 0))
                   AS u,
                   row_number() OVER (PARTITION BY card_id, tap_s, board_route, board_direction_id
                                      ORDER BY alight_s, stop_id) AS pl
            FROM left_off) x) y""",
    "chosen": f"""
SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY card_id, tap_s
   ORDER BY confidence DESC NULLS LAST, {_PREFER}) AS n FROM confident) x WHERE n = 1""",
    "rides": """
SELECT c.*, l.direction_id, l.fare_category_description, l.is_unwanted_operator, l.stop_id_next
FROM chosen c JOIN legs l ON l.card_id = c.card_id AND l.tap_s = c.tap_s""",
    "ended": """
SELECT *, CASE WHEN wait_seconds IS NULL OR next_headway IS NULL OR wait_seconds > 7200
               OR wait_seconds / next_headway > 3 - 2 * (1 / (1 + pow(exp(-1 * (next_headway - 15)), 0.5)))
          THEN true ELSE false END AS is_journey_end
FROM (SELECT *, lead(headway) OVER (PARTITION BY card_id ORDER BY tap_s) AS next_headway,
             next_s - alight_s - transfer_seconds AS wait_seconds FROM rides) x""",
    "journeys": """
SELECT * EXCLUDE (jn, ps, st), first_value(sha256(card_id || st)) OVER (PARTITION BY card_id, jn ORDER BY tap_s)
         AS journey_id
FROM (SELECT *, sum(CASE WHEN ps IS NULL OR ps THEN 1 ELSE 0 END) OVER (PARTITION BY card_id ORDER BY tap_s) AS jn
      FROM (SELECT *, lag(is_journey_end) OVER (PARTITION BY card_id ORDER BY tap_s) AS ps,
                   strftime(make_timestamp(tap_s * 1000000), '%Y-%m-%d %H:%M:%S') AS st FROM ended) x) y""",
    "judged": f"""
SELECT *, sum(len(reasons)) OVER (PARTITION BY card_id, journey_id) > 0 AS is_impossible
FROM (SELECT *, list_sort(list_distinct(list_filter([
  CASE WHEN alight_s = next_s THEN 'ALIGHTING DATETIME EQUAL TO NEXT BOARDING DATETIME' END,
  CASE WHEN stop_id = stop_id_next THEN 'NEXT STOP ID IS SAME AS CURRENT' END,
  CASE WHEN alight_s + transfer_seconds > next_s + 300
       THEN 'ALIGHTING TIME PLUS TRANSFER TIME IS AFTER NEXT BOARDING TIME' END,
  CASE WHEN alight_s <= tap_s OR alight_s > next_s THEN 'ALIGHTING TIME IS BEFORE BOARDING TIME' END,
  CASE WHEN (is_unwanted_operator AND run_id IS NULL) OR stop_id IS NULL THEN 'FAILED TO FIND BOARDING TRIP ID' END,
  CASE WHEN stop_lat IS NULL OR stop_lon IS NULL THEN 'STOP_LAT OR STOP_LON ARE NULL' END,
  CASE WHEN line_id IS NULL THEN 'LINE ID IS NULL' END,
  CASE WHEN run_id IS NOT NULL AND next_s IS NOT NULL AND wait_seconds IS NULL
       THEN 'COULD NOT CALCULATE INFERRED WAIT TIME' END,
  CASE WHEN run_id IS NOT NULL AND transfer_meters IS NULL THEN 'COULD NOT CALCULATE TRANSFER DISTANCE' END,
  CASE WHEN run_id IS NOT NULL AND confidence IS NULL THEN 'COULD NOT CALCULATE CONFIDENCE SCORE' END,
  CASE WHEN run_id IS NOT NULL AND boarding_probability IS NULL
       THEN 'COULD NOT CALCULATE BOARDING PROBABILITY' END,
  CASE WHEN alight_stop_id IS NOT NULL AND alighting_probability IS NULL
       THEN 'COULD NOT CALCULATE ALIGHTING PROBABILITY' END,
  CASE WHEN is_unwanted_operator THEN 'OPERATOR IS UNWANTED' END,
  CASE WHEN run_id IS NOT NULL AND stop_lat IS NULL THEN 'BOARDING STOP HAS NO LOCATION' END,
  CASE WHEN next_s IS NULL THEN 'NO DESTINATION BOARDING TAP' END,
  CASE WHEN next_s - tap_s > 7 * 86400 THEN 'DESTINATION BOARDING TAP IS MORE THAN 7 DAYS IN THE FUTURE' END,
  CASE WHEN next_s IS NOT NULL AND next_headway IS NULL
       THEN 'NO BOARDING INTERVAL AT DESTINATION BOARDING TAP' END,
  CASE WHEN run_id IS NOT NULL AND headway IS NULL THEN 'NO BOARDING INTERVAL BOARDING TAP' END,
  CASE WHEN board_route IS NULL THEN 'OLD LINE ID IS NULL' END,
  CASE WHEN {meters('stop_lat', 'stop_lon', 'alight_lat', 'alight_lon')} / nullif(alight_s - arrive_s, 0) > 30
       THEN 'VEHICLE ACCOMPLISHED RIDE FASTER THAN 75 MPH' END], lambda x: x IS NOT NULL))) AS reasons
FROM journeys) x""",
    "valid": f"""
SELECT *, CASE WHEN oo = 0 THEN 0 ELSE 1 / (1 + mx / nullif(oo, 0)) END AS validity_score
FROM (SELECT *, {meters('stop_lat', 'stop_lon', 'next_lat', 'next_lon')} AS oo,
             max(transfer_meters) OVER (PARTITION BY journey_id ORDER BY tap_s) AS mx
      FROM judged WHERE NOT is_impossible) x""",
    "passes": """
SELECT v.*, i.arr_s AS in_s, i.dep_s AS out_s, i.stop_id AS i_stop, i.stop_lat AS i_lat, i.stop_lon AS i_lon,
       i.stop_sequence AS i_sequence
FROM valid v JOIN runs i ON i.stop_type = 'INTERLINE' AND i.service_date = v.service_date AND i.run_id = v.run_id
 AND i.stop_sequence > v.board_sequence AND i.stop_sequence < v.alight_sequence
WHERE v.board_route <> v.alight_route""",
    "ride_events": """
SELECT fare_category_description, arrive_s AS dt_s, stop_id, card_id, journey_id, board_route AS line_id, stop_lat,
       stop_lon, board_direction_id AS direction_id, validity_score, 'BOARDED' AS event, 1.0::double AS confidence
FROM valid
UNION ALL
SELECT fare_category_description, alight_s, alight_stop_id, card_id, journey_id, alight_route, alight_lat, alight_lon,
       board_direction_id, validity_score, 'ALIGHTED', confidence
FROM valid WHERE next_s IS NOT NULL AND alight_stop_id IS NOT NULL
UNION ALL
SELECT fare_category_description, in_s, i_stop, card_id, journey_id, board_route, i_lat, i_lon, board_direction_id,
       validity_score, 'INTERLINE_STARTED', confidence
FROM passes WHERE i_lat IS NOT NULL AND next_s IS NOT NULL AND in_s > arrive_s AND out_s < alight_s
UNION ALL
SELECT fare_category_description, out_s, i_stop, card_id, journey_id, alight_route, i_lat, i_lon, board_direction_id,
       validity_score, 'INTERLINE_ENDED', confidence
FROM passes WHERE i_lat IS NOT NULL AND next_s IS NOT NULL AND in_s > arrive_s AND out_s < alight_s""",
    "typed": f"""
SELECT e.*, CASE WHEN e.event LIKE 'INTERLINE%' THEN 'MID_JOURNEY'
            WHEN e.event = 'BOARDED' AND r.n = 1 THEN 'ORIGIN'
            WHEN e.event = 'ALIGHTED' AND r.n = r.of_n THEN 'DESTINATION' ELSE 'MID_JOURNEY' END AS event_type
FROM (SELECT *, row_number() OVER () AS id FROM ride_events) e
LEFT JOIN (SELECT id, row_number() OVER (PARTITION BY journey_id ORDER BY {_EVENT_ORDER}) AS n,
                  count(*) OVER (PARTITION BY journey_id) AS of_n
           FROM (SELECT *, row_number() OVER () AS id FROM ride_events) x WHERE event NOT LIKE 'INTERLINE%') r
  ON r.id = e.id""",
    "looped": f"""
SELECT * EXCLUDE (id), coalesce({meters('last_value(stop_lat) OVER w', 'last_value(stop_lon) OVER w',
                        'first_value(stop_lat) OVER w', 'first_value(stop_lon) OVER w')} < 61, false) AS is_loop
FROM typed WINDOW w AS (PARTITION BY journey_id ORDER BY {_EVENT_ORDER}
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "rider_events": f"""
SELECT * EXCLUDE (odd), CAST(make_timestamp(min(dt_s) OVER (PARTITION BY journey_id) * 1000000) AS date)
         AS journey_start_date
FROM (SELECT * EXCLUDE (pair), sum(CASE WHEN pair IN ('BOARDED-ALIGHTED', 'BOARDED-INTERLINE_STARTED',
                 'INTERLINE_STARTED-INTERLINE_ENDED', 'INTERLINE_ENDED-INTERLINE_STARTED',
                 'INTERLINE_ENDED-ALIGHTED', 'ALIGHTED-BOARDED', 'ALIGHTED-NONE') THEN 0 ELSE 1 END)
               OVER (PARTITION BY journey_id) AS odd
      FROM (SELECT *, event || '-' || coalesce(lead(event) OVER (PARTITION BY journey_id ORDER BY {_EVENT_ORDER}),
                   'NONE') AS pair FROM looped) x) y
WHERE odd = 0""",
}

STEPS: dict[str, str] = {
    **FIXTURE_SQL,
    "tap_clean": f"""
SELECT event_id, card_id, tap_time, service_date, {alias_line('line_id')} AS line_id, line_id AS line_id_old, stop_id,
       direction_id, operatedby_description,
       coalesce(transaction_ticket_description, 'Unknown') AS transaction_ticket_description,
       fare_category_description, CAST(epoch(CAST(tap_time AS timestamp)) AS bigint) AS tap_s
FROM fx_taps WHERE stop_id <> -1""",
    "tap_last": """
SELECT * EXCLUDE (nx) FROM (SELECT *, lead(tap_s) OVER (PARTITION BY card_id ORDER BY tap_s, event_id) AS nx
                            FROM tap_clean) x
WHERE nx IS NULL OR nx - tap_s >= 20""",
    "taps": """
SELECT *, CAST(make_timestamp(tap_s * 1000000) AS date) AS date,
       operatedby_description IS NULL OR operatedby_description IN ('OTHER') AS is_unwanted_operator
FROM tap_last
WHERE date_trunc('month', service_date) = (SELECT date_trunc('month', max(service_date)) FROM tap_last)""",
    "visit_times": f"""
SELECT trip_id, CAST(stop_id AS int) AS stop_id, stop_sequence, service_date,
       {_clock('service_date', 'actual_arrive_time')} AS arr_s,
       {_clock('service_date', 'actual_departure_time')} AS dep_s
FROM fx_stop_events""",
    "nearest": """
SELECT * FROM (SELECT d.stop_id, d.service_date, s.stop_lat, s.stop_lon, row_number() OVER (
                 PARTITION BY d.stop_id, d.service_date
                 ORDER BY abs(date_diff('day', s.release_date, d.service_date)), s.release_date) AS n
               FROM (SELECT DISTINCT stop_id, service_date FROM visit_times) d
               JOIN fx_stops s ON s.stop_id = d.stop_id) x WHERE n = 1""",
    "located": """
SELECT v.*, CAST(regexp_replace(t.route_id, '[a-z]', '', 'g') AS int) AS route_id, t.service_id, t.direction_id,
       t.block_id, p.stop_lat, p.stop_lon
FROM visit_times v LEFT JOIN fx_trips t ON t.trip_id = v.trip_id
LEFT JOIN nearest p ON p.stop_id = v.stop_id AND p.service_date = v.service_date
WHERE v.service_date IN (SELECT service_date FROM taps)""",
    "merged": """
SELECT * EXCLUDE (nx) FROM (SELECT *, lead(stop_id) OVER (PARTITION BY service_date, trip_id
                              ORDER BY arr_s, stop_sequence) AS nx FROM located) x
WHERE nx IS NULL OR nx <> stop_id""",
    "visits": f"""
SELECT * EXCLUDE (m, route_id), {alias_line('route_id')} AS route_id, route_id AS route_id_old,
       CASE WHEN m < 60 THEN 60 WHEN m IS NULL THEN first_value(m IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW
            AND UNBOUNDED FOLLOWING) ELSE m END AS headway
FROM (SELECT *, avg(arrival_delta) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS m
      FROM (SELECT *, arr_s - lag(arr_s) OVER w AS arrival_delta FROM merged
            WINDOW w AS (PARTITION BY route_id, stop_id, service_date, direction_id
                         ORDER BY arr_s, trip_id, stop_sequence)) x
      WINDOW w AS (PARTITION BY route_id, stop_id, service_date, direction_id
                   ORDER BY arr_s, trip_id, stop_sequence)) y
WINDOW w AS (PARTITION BY route_id, stop_id, service_date, direction_id ORDER BY arr_s, trip_id, stop_sequence)""",
    "trip_ends": """
SELECT service_date, trip_id, min(route_id) AS route_id, min(service_id) AS service_id, min(block_id) AS block_id,
       arg_min(stop_id, stop_sequence) AS start_stop_id, arg_max(stop_id, stop_sequence) AS end_stop_id,
       arg_min(arr_s, stop_sequence) AS start_s, arg_max(arr_s, stop_sequence) AS end_s
FROM located GROUP BY service_date, trip_id""",
    "blocks": """
SELECT *, CASE WHEN end_stop_id = start_stop_id_next AND route_id <> route_id_next THEN trip_id_next END
         AS interlines_with_trip_id
FROM (SELECT *, lead(trip_id) OVER w AS trip_id_next, lead(route_id) OVER w AS route_id_next,
             lead(start_stop_id) OVER w AS start_stop_id_next
      FROM trip_ends WINDOW w AS (PARTITION BY service_date, block_id, service_id ORDER BY start_s, trip_id)) x""",
    "walk": """
SELECT service_date, trip_id AS head, trip_id, 1 AS pos FROM blocks b
WHERE NOT EXISTS (SELECT 1 FROM blocks k WHERE k.service_date = b.service_date
                  AND k.interlines_with_trip_id = b.trip_id)
UNION ALL
SELECT w.service_date, w.head, b.interlines_with_trip_id, w.pos + 1
FROM walk w JOIN blocks b ON b.service_date = w.service_date AND b.trip_id = w.trip_id
WHERE b.interlines_with_trip_id IS NOT NULL""",
    "chains": """
SELECT w.service_date, w.trip_id, CASE WHEN c.n > 1
         THEN CAST(('0x' || substr(sha256('[' || c.ids || ']'), 1, 16))::UBIGINT AS decimal(38,0))
         ELSE CAST(w.trip_id AS decimal(38,0)) END AS interlining_trip_id
FROM walk w JOIN (SELECT service_date, head, count(*) AS n,
                         string_agg(CAST(trip_id AS varchar), ',' ORDER BY pos) AS ids
                  FROM walk GROUP BY service_date, head) c
  ON c.service_date = w.service_date AND c.head = w.head""",
    "runs": _runs(True),
    "places": """
SELECT stop_id, round(avg(stop_lat), 9) AS stop_lat, round(avg(stop_lon), 9) AS stop_lon
FROM runs GROUP BY stop_id""",
    "legs": f"""
SELECT *, {_NEXT}
FROM (SELECT t.*, p.stop_lat, p.stop_lon FROM taps t LEFT JOIN places p ON p.stop_id = t.stop_id) x
WINDOW w AS (PARTITION BY card_id ORDER BY tap_s, event_id)""",
    "platform_stops": """
SELECT * FROM (SELECT stop_id, route_id, stop_lat, stop_lon, row_number() OVER (PARTITION BY stop_id
                 ORDER BY route_id <> 200, route_id, stop_lat, stop_lon) AS n
               FROM (SELECT DISTINCT stop_id, route_id, stop_lat, stop_lon FROM runs
                     WHERE route_id = 200 OR stop_id IN (7999)) x) y WHERE n = 1""",
    "alternatives": f"""
SELECT a.stop_id, a.route_id, a.stop_lat, a.stop_lon, b.stop_id AS stop_id_alternative,
       b.stop_lat AS stop_lat_alternative, b.stop_lon AS stop_lon_alternative
FROM platform_stops a LEFT JOIN platform_stops b
  ON {meters('a.stop_lat', 'a.stop_lon', 'b.stop_lat', 'b.stop_lon')} < 153
WHERE a.route_id = 200 OR a.stop_id = b.stop_id""",
    "platform_taps": """
SELECT l.card_id, l.tap_s, l.tap_s_next AS next_s, l.service_date, l.line_id, l.stop_id AS stop_id_old,
       a.stop_id_alternative AS stop_id, a.stop_lat_alternative AS stop_lat, a.stop_lon_alternative AS stop_lon,
       l.stop_lat_next AS next_lat, l.stop_lon_next AS next_lon
FROM legs l LEFT JOIN alternatives a ON a.stop_id = l.stop_id WHERE l.line_id = 200""",
    "platform_options": """
SELECT t.*, v.arr_s AS arrive_s, v.dep_s AS depart_s, v.route_id_old AS board_route,
       v.direction_id AS board_direction_id, v.stop_sequence AS board_sequence, v.headway, v.run_id,
       row_number() OVER (PARTITION BY t.card_id, t.tap_s, v.route_id_old, v.direction_id
                          ORDER BY v.dep_s, v.run_id, v.stop_sequence, t.stop_id) AS n
FROM platform_taps t LEFT JOIN runs v ON v.service_date = t.service_date AND v.stop_id = t.stop_id
 AND v.route_id = t.line_id AND t.tap_s <= v.dep_s""",
    "onboard_options": """
SELECT l.card_id, l.tap_s, l.tap_s_next AS next_s, l.service_date, l.line_id, l.stop_id AS stop_id_old, l.stop_id,
       l.stop_lat, l.stop_lon, l.stop_lat_next AS next_lat, l.stop_lon_next AS next_lon,
       v.arr_s AS arrive_s, v.dep_s AS depart_s, v.route_id_old AS board_route, v.direction_id AS board_direction_id,
       v.stop_sequence AS board_sequence, v.headway, v.run_id,
       row_number() OVER (PARTITION BY l.card_id, l.tap_s
                          ORDER BY v.arr_s DESC, v.run_id DESC, v.stop_sequence DESC) AS n
FROM legs l LEFT JOIN runs v ON v.service_date = l.service_date AND v.stop_id = l.stop_id AND v.route_id = l.line_id
 AND l.tap_s >= v.arr_s
WHERE l.line_id <> 200""",
    **_SCORES,
    "failed": "SELECT * FROM judged WHERE is_impossible",
    "failed_events": """
SELECT card_id, journey_id, tap_s AS dt_s, stop_id, board_route AS line_id, stop_lat, stop_lon, direction_id,
       service_date, 'BOARDED' AS event, 1.0::double AS confidence, array_to_string(reasons, ';') AS reasons FROM failed
UNION ALL
SELECT card_id, journey_id, alight_s, alight_stop_id, alight_route, alight_lat, alight_lon, direction_id, service_date,
       'ALIGHTED', confidence, array_to_string(reasons, ';') FROM failed WHERE stop_id_next IS NOT NULL""",
    "following": """
SELECT line_id, stop_id, direction_id, following AS trip_stop_id_next
FROM (SELECT *, row_number() OVER (PARTITION BY line_id, stop_id, direction_id ORDER BY trip_id, stop_sequence) AS n
      FROM (SELECT *, lead(stop_id) OVER (PARTITION BY trip_id ORDER BY stop_sequence) AS following
            FROM (SELECT trip_id, stop_sequence, stop_id, route_id_old AS line_id, direction_id,
                         row_number() OVER (PARTITION BY trip_id, stop_sequence ORDER BY service_date, arr_s, stop_id) AS k
                  FROM visits) x WHERE k = 1) y) z WHERE n = 1""",
    "rides_only": f"""
SELECT *, lead(stop_lat) OVER w AS n_lat, lead(stop_lon) OVER w AS n_lon
FROM rider_events WHERE event IN ('BOARDED', 'ALIGHTED')
WINDOW w AS (PARTITION BY journey_id ORDER BY {_EVENT_ORDER})""",
    "ends_only": f"""
SELECT *, lead(stop_lat) OVER w AS n_lat, lead(stop_lon) OVER w AS n_lon
FROM rider_events WHERE event_type IN ('ORIGIN', 'DESTINATION')
WINDOW w AS (PARTITION BY journey_id ORDER BY {_EVENT_ORDER})""",
    "origins_only": f"""
SELECT *, lead(stop_lat) OVER w AS n_lat, lead(stop_lon) OVER w AS n_lon
FROM rider_events WHERE event_type = 'ORIGIN' WINDOW w AS (PARTITION BY card_id ORDER BY {_EVENT_ORDER})""",
    "k_single": f"""
SELECT e.journey_id, max(CASE WHEN e.n_stop = f.trip_stop_id_next THEN 1 ELSE 0 END) AS is_single_stop_ride
FROM (SELECT *, lead(stop_id) OVER w AS n_stop, lead(event_type) OVER w AS n_type FROM rider_events
      WINDOW w AS (PARTITION BY journey_id ORDER BY {_EVENT_ORDER})) e
LEFT JOIN following f ON f.line_id = e.line_id AND f.stop_id = e.stop_id AND f.direction_id = e.direction_id
WHERE e.event_type = 'ORIGIN' AND e.n_type = 'DESTINATION' GROUP BY e.journey_id""",
    "k_ride": f"""
SELECT journey_id, min(d) FILTER (event = 'BOARDED') AS leg_distance_meters_min,
       max(d) FILTER (event = 'BOARDED') AS leg_distance_meters_max,
       sum(d) FILTER (event = 'BOARDED') AS total_journey_distance_traveled_meters,
       max(d) FILTER (event = 'ALIGHTED') AS alighting_to_next_boarding_distance_meters_max,
       min(d) FILTER (event = 'ALIGHTED') AS alighting_to_next_boarding_distance_meters_min,
       count(*) FILTER (event = 'BOARDED') AS n_legs,
       min(confidence) FILTER (event = 'ALIGHTED') AS confidence_min,
       max(confidence) FILTER (event = 'ALIGHTED') AS confidence_max,
       avg(confidence) FILTER (event = 'ALIGHTED') AS confidence_mean
FROM (SELECT *, {meters('stop_lat', 'stop_lon', 'n_lat', 'n_lon')} AS d FROM rides_only) x GROUP BY journey_id""",
    "k_lines": """
SELECT journey_id, array_to_string(list_sort(list(DISTINCT line_id)), ',') AS line_ids_used,
       bool_or(line_id IN (200, 100, 190, 90, 290)) AS includes_platform,
       bool_and(line_id IN (200, 100, 190, 90, 290)) AS is_platform_only
FROM rider_events GROUP BY journey_id""",
    "k_ends": f"""
SELECT journey_id, {meters('stop_lat', 'stop_lon', 'n_lat', 'n_lon')} AS origin_destination_distance_meters
FROM ends_only WHERE event_type = 'ORIGIN' AND n_lat IS NOT NULL""",
    "k_origins": f"""
SELECT journey_id, {meters('stop_lat', 'stop_lon', 'n_lat', 'n_lon')} AS origin_origin_distance_meters
FROM origins_only WHERE n_lat IS NOT NULL""",
    "k_gap": f"""
SELECT journey_id, max(nx - dt_s) AS max_inter_boarding_time_seconds
FROM (SELECT *, lead(dt_s) OVER (PARTITION BY card_id ORDER BY {_EVENT_ORDER}) AS nx FROM rider_events
      WHERE event = 'BOARDED') x GROUP BY journey_id""",
    "k_time": """
SELECT o.journey_id, d.dt_s - o.dt_s AS journey_time_seconds FROM rider_events o JOIN rider_events d
  ON d.journey_id = o.journey_id AND d.event_type = 'DESTINATION' WHERE o.event_type = 'ORIGIN'""",
    "profiles": """
SELECT b.*, coalesce(s.is_single_stop_ride, 0) = 1 AS is_single_stop_ride, r.* EXCLUDE (journey_id),
       l.* EXCLUDE (journey_id), origin_destination_distance_meters, origin_origin_distance_meters,
       max_inter_boarding_time_seconds, journey_time_seconds,
       CASE WHEN is_platform_only THEN 'platform_only' WHEN includes_platform THEN 'mixed' ELSE 'onboard_only' END AS mode
FROM (SELECT DISTINCT journey_id, card_id, validity_score FROM rider_events) b
LEFT JOIN k_ride r ON r.journey_id = b.journey_id LEFT JOIN k_lines l ON l.journey_id = b.journey_id
LEFT JOIN k_single s ON s.journey_id = b.journey_id LEFT JOIN k_ends e ON e.journey_id = b.journey_id
LEFT JOIN k_origins o ON o.journey_id = b.journey_id LEFT JOIN k_gap g ON g.journey_id = b.journey_id
LEFT JOIN k_time t ON t.journey_id = b.journey_id""",
    "follow_any": """
SELECT line_id, stop_id, arg_min(trip_stop_id_next, direction_id) FILTER (first_dir = direction_id) AS trip_stop_id_next
FROM (SELECT *, min(direction_id) OVER (PARTITION BY line_id, stop_id) AS first_dir FROM following) x
GROUP BY line_id, stop_id""",
    "ahead": f"""
SELECT e.*, f.trip_stop_id_next,
       {meters('stop_lat', 'stop_lon', 'lat1', 'lon1')} AS distance_to_next_stop,
       {meters('stop_lat', 'stop_lon', 'lat2', 'lon2')} AS distance_to_next_next_stop,
       {meters('lat1', 'lon1', 'lat2', 'lon2')} AS alighting_distance_to_next_stop,
       CASE WHEN e.line_id IN (200, 190, 290, 90, 100) THEN 'Y' ELSE 'N' END AS is_platform
FROM (SELECT *, lead(stop_id) OVER w AS stop_id_next, lead(stop_lat) OVER w AS lat1, lead(stop_lon) OVER w AS lon1,
             lead(confidence) OVER w AS confidence_next, lead(stop_id, 2) OVER w AS stop_id_next_next,
             lead(stop_lat, 2) OVER w AS lat2, lead(stop_lon, 2) OVER w AS lon2, lead(event, 2) OVER w AS event_next_next,
             lead(event_type, 2) OVER w AS event_type_next_next, lead(dt_s, 2) OVER w AS dt2
      FROM (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY card_id, journey_id, dt_s, event
                                  ORDER BY stop_id, line_id) AS k FROM rider_events) q WHERE k = 1) p
      WINDOW w AS (PARTITION BY card_id ORDER BY {_EVENT_ORDER})) e
LEFT JOIN follow_any f ON f.line_id = e.line_id AND f.stop_id = e.stop_id""",
    "lone": """
SELECT *, CASE WHEN stop_id = stop_id_next_next THEN 'Y' ELSE 'N' END AS is_null_journey,
       CASE WHEN stop_id_next = trip_stop_id_next THEN 'Y' ELSE 'N' END AS is_single_stop_ride,
       CASE WHEN stop_id_next = stop_id_next_next THEN 'Y' ELSE 'N' END AS alight_at_next_start_location
FROM ahead WHERE event_type = 'ORIGIN' AND event_type_next_next = 'ORIGIN'""",
    # a control run without interlining, for the run comparison
    "c_runs": _runs(False),
    "both_sides": """
SELECT *, 'all' AS side FROM profiles UNION ALL SELECT *, 'above' FROM profiles WHERE validity_score > 0.5""",
}

# The control run repeats the steps after the visits under other names.
_AGAIN = [
    "places", "legs", "platform_stops", "alternatives", "platform_taps", "platform_options", "onboard_options",
    *_SCORES, "ahead", "lone",
]
for _name in _AGAIN:
    _text = STEPS[_name]
    for _other in ["runs", *_AGAIN]:
        _text = re.sub(rf"\b(FROM|JOIN) {_other}\b", rf"\1 c_{_other}", _text)
    STEPS[f"c_{_name}"] = _text


def _needed(text: str, found: dict[str, None]) -> None:
    for name in re.findall(r"\b(?:FROM|JOIN) (\w+)", text):
        if name in STEPS and name not in found:
            found[name] = None
            _needed(STEPS[name], found)


def sql(select: str) -> str:
    """A query text with just the steps that it needs, in order."""
    found: dict[str, None] = {}
    _needed(select, found)
    order: list[str] = []

    def place(name: str) -> None:
        if name in order:
            return
        inner: dict[str, None] = {}
        for n in re.findall(r"\b(?:FROM|JOIN) (\w+)", STEPS[name]):
            if n in STEPS and n != name:
                inner[n] = None
        for n in inner:
            place(n)
        order.append(name)

    for name in found:
        place(name)
    if not order:
        return select
    parts = [f"{n} {'AS' if n == 'walk' else _FREEZE} ({STEPS[n]})" for n in order]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select
