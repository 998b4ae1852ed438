"""Registered queries, each with the SQL text that must give the same rows.

``@query(name, sql)`` takes a function of a ``World``. Doubles are rounded on
both sides, meters and seconds to four digits and all others to six; times are epoch seconds; arrays are joined to text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.oracle import sql
from checks.world import S, World, world
from tapweave.config import PLATFORM_REPORT_LINES, VISIT_SOURCE
from tapweave.functions.geo import great_circle_meters
from tapweave.functions.quantiles import exact_quantiles
from tapweave.functions.stage import fresh_path
from tapweave.operators import (
    alighting, boarding, compare, interline, journeys, metrics, profiles, relational, schedule, taps, visits,
)
from tapweave.sources import readers, sinks

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def register(build: Callable[[World], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(world(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = sql(oracle)
        return build

    return register


def r6(*names: str) -> list[str]:
    return [f"round({n}, 6) AS {n.split('.')[-1]}" for n in names]


def r6s(*names: str) -> str:
    return ", ".join(r6(*names))


def r4(*names: str) -> list[str]:
    """Meters and seconds: a haversine of near points is good to about 1e-9 of these."""
    return [f"round({n}, 4) AS {n.split('.')[-1]}" for n in names]


def r4s(*names: str) -> str:
    return ", ".join(r4(*names))


TAP_S = "CAST(datetime AS bigint) AS tap_s"
ARR = ["CAST(arrive_datetime AS bigint) AS arr_s", "CAST(departure_datetime AS bigint) AS dep_s"]


def scratch(w: World) -> str:
    """A folder of its own for each call, next to the written steps."""
    return fresh_path(w.spark, "io")


# ---------------------------------------------------------------- projection, filter, cleaning


@query("P1_upper_case_columns", 'SELECT event_id AS "EVENT_ID", card_id AS "CARD_ID", tap_time AS "TAP_TIME", line_id AS "LINE_ID", stop_id AS "STOP_ID" FROM fx_taps')
def _(w):
    df = taps.upper_case_columns(w.raw("taps"))
    return df.select([c for c in df.columns if c in ("EVENT_ID", "CARD_ID", "TAP_TIME", "LINE_ID", "STOP_ID")])


@query("P2_null_counts", """SELECT c AS column_name, n AS n_null FROM (
 SELECT 'card_id' AS c, count(*) FILTER (card_id IS NULL) AS n FROM fx_taps
 UNION ALL SELECT 'operatedby_description', count(*) FILTER (operatedby_description IS NULL) FROM fx_taps
 UNION ALL SELECT 'transaction_ticket_description', count(*) FILTER (transaction_ticket_description IS NULL) FROM fx_taps) x""")
def _(w):
    return taps.null_counts(w.raw("taps"), ["card_id", "operatedby_description", "transaction_ticket_description"])


@query("P3_fill_unknown_ticket", "SELECT event_id, coalesce(transaction_ticket_description, 'Unknown') AS transaction_ticket_description FROM fx_taps")
def _(w):
    return taps.fill_unknown_ticket(w.raw("taps")).select("event_id", "transaction_ticket_description")


@query("P4_alias_lines", "SELECT t.trip_id, CASE WHEN r IN (90, 100) THEN 200 ELSE r END AS route_id, r AS route_id_old FROM (SELECT trip_id, CAST(regexp_replace(route_id, '[a-z]', '', 'g') AS int) AS r FROM fx_trips) t")
def _(w):
    return taps.alias_lines(visits.numeric_routes(w.raw("trips")), S.line_aliases, "route_id").select(
        "trip_id", "route_id", "route_id_old"
    )


@query("P5_drop_unknown_stops", "SELECT event_id, stop_id FROM fx_taps WHERE stop_id <> -1")
def _(w):
    return taps.drop_unknown_stops(w.raw("taps")).select("event_id", "stop_id")


@query("P6_parse_datetime", "SELECT event_id, CAST(epoch(CAST(tap_time AS timestamp)) AS bigint) AS tap_s FROM fx_taps")
def _(w):
    return taps.parse_datetime(w.raw("taps")).selectExpr("event_id", TAP_S)


@query("P7_add_date", "SELECT event_id, CAST(CAST(CAST(tap_time AS timestamp) AS date) AS varchar) AS date FROM fx_taps")
def _(w):
    return taps.add_date(taps.parse_datetime(w.raw("taps"))).selectExpr("event_id", "CAST(date AS string) AS date")


@query("P7_date_with_pattern", "SELECT service_id, CAST(strptime(CAST(date AS varchar), '%Y%m%d')::date AS varchar) AS date FROM fx_calendar_dates")
def _(w):
    df = w.raw("calendar_dates").withColumnRenamed("date", "day_number")
    return taps.add_date(df, "day_number", "yyyyMMdd").selectExpr("service_id", "CAST(date AS string) AS date")


@query("P8_arrival_hour", "SELECT trip_id, stop_sequence, CAST((arr_s // 3600) % 24 AS int) AS hour FROM visit_times")
def _(w):
    return visits.add_hour(visits.add_visit_times(w.raw("stop_events"))).select("trip_id", "stop_sequence", "hour")


@query("P9_unwanted_operators", "SELECT event_id, operatedby_description IS NULL OR operatedby_description IN ('OTHER') AS is_unwanted_operator FROM fx_taps")
def _(w):
    return taps.tag_unwanted_operators(w.raw("taps"), S.unwanted_operators).select("event_id", "is_unwanted_operator")


@query("P10_add_source", f"SELECT trip_id, stop_sequence, '{VISIT_SOURCE}' AS source FROM fx_stop_events")
def _(w):
    return visits.add_source(w.raw("stop_events"), VISIT_SOURCE).select("trip_id", "stop_sequence", "source")


@query("P11_numeric_routes", "SELECT trip_id, CAST(regexp_replace(route_id, '[a-z]', '', 'g') AS int) AS route_id FROM fx_trips")
def _(w):
    return visits.numeric_routes(w.raw("trips")).select("trip_id", "route_id")


@query("P12_service_clock", "SELECT trip_id, stop_id, stop_sequence, arr_s, dep_s FROM visit_times")
def _(w):
    return visits.add_visit_times(w.raw("stop_events")).selectExpr("trip_id", "stop_id", "stop_sequence", *ARR)


def spread_over_months(w: World) -> DataFrame:
    """Taps dealt over four months, so that a choice of months leaves some out."""
    return w.raw("taps").withColumn("service_date", F.expr("CAST(add_months(service_date, -CAST(event_id % 4 AS int)) AS date)"))


_MONTHS = "(SELECT event_id, CAST(service_date - to_months(CAST(event_id % 4 AS int)) AS date) AS service_date FROM fx_taps)"


@query("P13_latest_month", f"SELECT event_id, CAST(service_date AS varchar) AS service_date FROM {_MONTHS} t WHERE date_trunc('month', service_date) = (SELECT date_trunc('month', max(service_date)) FROM {_MONTHS} u)")
def _(w):
    return taps.select_months(spread_over_months(w), "service_date").selectExpr("event_id", "CAST(service_date AS string) AS service_date")


@query("P13_listed_months", f"SELECT event_id FROM {_MONTHS} t WHERE (year(service_date) = 2024 AND month(service_date) = 1) OR (year(service_date) = 2023 AND month(service_date) = 11)")
def _(w):
    return taps.select_months(spread_over_months(w), "service_date", [(2024, 1), (2023, 11)]).select("event_id")


@query("P14_tapped_dates", """SELECT trip_id, stop_sequence, CAST(service_date AS varchar) AS service_date FROM (
 SELECT trip_id, stop_sequence, service_date FROM fx_stop_events UNION ALL
 SELECT trip_id, stop_sequence, CAST(service_date - to_days(CAST(stop_sequence * 9 AS int)) AS date) FROM fx_stop_events) v
WHERE service_date IN (SELECT service_date FROM fx_taps)""")
def _(w):
    # all visits, and all of them again some days or weeks earlier, most of these before the first tap
    every = w.raw("stop_events").select("trip_id", "stop_sequence", "service_date")
    earlier = every.withColumn("service_date", F.expr("date_sub(service_date, CAST(stop_sequence * 9 AS int))"))
    return visits.keep_tapped_dates(every.unionByName(earlier), w.raw("taps")).selectExpr(
        "trip_id", "stop_sequence", "CAST(service_date AS string) AS service_date"
    )


@query("P15_spread_by", "SELECT CAST(service_date AS varchar) AS service_date, event_id FROM fx_taps")
def _(w):
    return visits.spread_by(w.raw("taps"), "service_date").selectExpr("CAST(service_date AS string) AS service_date", "event_id")


_SHOWN = (
    "journey_id card_id event stop_id line_id direction_id event_type is_loop fare_category_description stop_lat stop_lon"
    " validity_score confidence"
).split()


@query("P16_null_report", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM looped" for c in _SHOWN)
       + " UNION ALL SELECT 'datetime', count(*) FILTER (dt_s IS NULL) FROM looped")
def _(w):
    return journeys.null_report(w.looped)


@query("P17_contains", "SELECT journey_id, event, dt_s, stop_id FROM looped WHERE contains(event, 'INTERLINE')")
def _(w):
    return w.looped.where(F.col("event").contains("INTERLINE")).selectExpr("journey_id", "event", "CAST(datetime AS bigint) AS dt_s", "stop_id")


# ---------------------------------------------------------------- joins


@query("J1_trip_data", "SELECT v.trip_id, stop_sequence, route_id, service_id, direction_id, block_id FROM fx_stop_events v LEFT JOIN fx_trips t ON t.trip_id = v.trip_id")
def _(w):
    return visits.add_trip_data(w.raw("stop_events"), w.raw("trips")).select(
        "trip_id", "stop_sequence", "route_id", "service_id", "direction_id", "block_id"
    )


@query("J1_missing_trips", """SELECT DISTINCT CAST(service_date AS varchar) AS service_date FROM fx_stop_events
WHERE trip_id NOT IN (SELECT trip_id FROM fx_trips WHERE trip_id % 90 <> 4 AND route_id IS NOT NULL)""")
def _(w):
    # some trips of one service day have no route
    route = F.when(F.col("trip_id") % 90 != 4, F.col("route_id"))
    return visits.dates_without_trip_data(w.raw("stop_events"), w.raw("trips").withColumn("route_id", route)).selectExpr(
        "CAST(service_date AS string) AS service_date"
    )


@query("J2_nearest_release", f"SELECT v.trip_id, v.stop_sequence, v.stop_id, {r6s('stop_lat', 'stop_lon')} FROM visit_times v LEFT JOIN nearest n ON n.stop_id = v.stop_id AND n.service_date = v.service_date")
def _(w):
    df = visits.add_stop_locations(visits.add_visit_times(w.raw("stop_events")), w.raw("stops"))
    return df.selectExpr("trip_id", "stop_sequence", "stop_id", *r6("stop_lat", "stop_lon"))


@query("J3_locate_taps", f"SELECT t.event_id, t.stop_id, {r6s('p.stop_lat', 'p.stop_lon')} FROM taps t LEFT JOIN places p ON p.stop_id = t.stop_id")
def _(w):
    return taps.locate_taps(w.taps, w.runs).selectExpr("event_id", "stop_id", *r6("stop_lat", "stop_lon"))


@query("J4_platform_alternatives", f"SELECT stop_id, route_id, stop_id_alternative, {r6s('stop_lat_alternative', 'stop_lon_alternative')} FROM alternatives")
def _(w):
    return w.alternatives.selectExpr(
        "stop_id", "route_id", "stop_id_alternative", *r6("stop_lat_alternative", "stop_lon_alternative")
    )


CANDIDATE = ["card_id", "tap_s", "stop_id", "arrive_s", "depart_s", "board_route", "board_direction_id", "board_sequence", "run_id"]


@query("J5_platform_boardings", f"SELECT {', '.join(CANDIDATE)} FROM platform_options WHERE n <= 2")
def _(w):
    return w.platform.select(*CANDIDATE)


@query("J6_onboard_boardings", f"SELECT {', '.join(CANDIDATE)} FROM onboard_options WHERE n <= 3")
def _(w):
    return w.onboard.select(*CANDIDATE)


REACHED = ["card_id", "tap_s", "run_id", "board_sequence", "stop_id", "alight_s", "alight_stop_id", "alight_sequence"]


@query("J7_alighting_candidates", f"SELECT {', '.join(REACHED)} FROM reached")
def _(w):
    return w.reached.select(*REACHED)


@query("J8_interline_events", "SELECT card_id, tap_s, run_id, i_sequence AS interline_sequence, i_stop AS interline_stop_id, in_s, out_s FROM passes")
def _(w):
    return interline.interline_events(w.valid, w.runs).selectExpr(
        "card_id", "tap_s", "run_id", "interline_sequence", "interline_stop_id",
        "CAST(interline_arrive AS bigint) AS in_s", "CAST(interline_departure AS bigint) AS out_s",
    )


@query("J9_insert_chain_ids", "SELECT v.trip_id, v.stop_sequence, CAST(c.interlining_trip_id AS varchar) AS interlining_trip_id FROM visits v LEFT JOIN chains c ON c.service_date = v.service_date AND c.trip_id = v.trip_id")
def _(w):
    return w.visits.join(w.chains, ["service_date", "trip_id"], "left").selectExpr(
        "trip_id", "stop_sequence", "CAST(interlining_trip_id AS string) AS interlining_trip_id"
    )


@query("J10_utility_sums", "SELECT card_id, tap_s, run_id, alight_sequence, board_sequence, stop_id, alight_stop_id, round(confidence, 6) AS confidence FROM confident")
def _(w):
    return alighting.add_confidence(w.scored).selectExpr(
        "card_id", "tap_s", "run_id", "alight_sequence", "board_sequence", "stop_id", "alight_stop_id", *r6("confidence")
    )


@query("J12_share_of_total", "SELECT line_id, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM fx_taps), 6) AS share FROM fx_taps GROUP BY line_id")
def _(w):
    t = w.raw("taps")
    total = t.agg(F.count(F.lit(1)).alias("total"))
    return t.groupBy("line_id").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(total)).selectExpr(
        "line_id", "n", "round(100.0D * n / total, 6) AS share"
    )


@query("J13_cards_of_control", "SELECT c.card_id, e.journey_id, e.event, e.dt_s FROM rider_events e RIGHT JOIN (SELECT DISTINCT card_id FROM taps) c ON c.card_id = e.card_id")
def _(w):
    return compare.of_cards_in(w.events, w.taps).selectExpr("card_id", "journey_id", "event", "CAST(datetime AS bigint) AS dt_s")


_SHARES = """SELECT * FROM (SELECT line_id, count(*) AS n, avg(confidence_next) AS mean_confidence,
 count(*) / sum(count(*)) OVER () * 100 AS percentage FROM {0} WHERE is_single_stop_ride = 'Y' GROUP BY line_id) s WHERE percentage > 0.01"""


@query("J14_K15_compare_runs", f"""SELECT coalesce(c.line_id, f.line_id) AS line_id, c.n AS n_control, f.n AS n_fixed,
 round(c.mean_confidence, 6) AS mean_confidence_control, round(f.mean_confidence, 6) AS mean_confidence_fixed,
 round(c.percentage, 6) AS percentage_control, round(f.percentage, 6) AS percentage_fixed
FROM ({_SHARES.format('c_lone')}) c FULL JOIN ({_SHARES.format('lone')}) f ON f.line_id = c.line_id""")
def _(w):
    df = compare.compare_line_shares(compare.line_shares(w.control_lone), compare.line_shares(w.lone))
    return df.selectExpr(
        "line_id", "n_control", "n_fixed",
        *r6("mean_confidence_control", "mean_confidence_fixed", "percentage_control", "percentage_fixed"),
    )


@query("J16_origin_destination_pairs", """SELECT o.journey_id, o.stop_id AS origin_stop, d.stop_id AS destination_stop
FROM rider_events o JOIN rider_events d ON d.journey_id = o.journey_id AND d.event_type = 'DESTINATION' WHERE o.event_type = 'ORIGIN'""")
def _(w):
    e = w.events
    o = e.where("event_type = 'ORIGIN'").selectExpr("journey_id", "stop_id AS origin_stop")
    d = e.where("event_type = 'DESTINATION'").selectExpr("journey_id", "stop_id AS destination_stop")
    return o.join(d, "journey_id")


@query("J17_journeys_at_stops", "SELECT journey_id, event, dt_s, stop_id FROM rider_events WHERE journey_id IN (SELECT journey_id FROM rider_events WHERE event = 'BOARDED' AND stop_id IN (3, 4, 5))")
def _(w):
    at = w.events.where("event = 'BOARDED' AND stop_id IN (3, 4, 5)")
    return w.events.join(at, "journey_id", "left_semi").selectExpr("journey_id", "event", "CAST(datetime AS bigint) AS dt_s", "stop_id")


# ---------------------------------------------------------------- windows and sequences


@query("W1_drop_bursts", "SELECT event_id, card_id, tap_s FROM tap_last")
def _(w):
    df = taps.parse_datetime(taps.drop_unknown_stops(w.raw("taps")))
    return taps.drop_bursts(df, S.burst_seconds).selectExpr("event_id", "card_id", TAP_S)


@query("prepared_taps", "SELECT event_id, card_id, CAST(service_date AS varchar) AS service_date, line_id, line_id_old, stop_id, direction_id, transaction_ticket_description, fare_category_description, is_unwanted_operator, tap_s FROM taps")
def _(w):
    return w.taps.selectExpr(
        "EVENT_ID AS event_id", "CARD_ID AS card_id", "CAST(service_date AS string) AS service_date", "line_id", "line_id_old",
        "STOP_ID AS stop_id", "DIRECTION_ID AS direction_id", "transaction_ticket_description",
        "FARE_CATEGORY_DESCRIPTION AS fare_category_description", "is_unwanted_operator", TAP_S,
    )


@query("W2_merge_repeated_stops", "SELECT trip_id, stop_sequence, stop_id, arr_s FROM merged")
def _(w):
    return w.merged.selectExpr("trip_id", "stop_sequence", "stop_id", ARR[0])


@query("W3_headways", f"SELECT trip_id, stop_sequence, arrival_delta, round(headway, 6) AS headway FROM visits")
def _(w):
    return visits.add_headways(w.merged).selectExpr(
        "trip_id", "stop_sequence", "arrival_delta", "round(mean_boarding_interval_seconds, 6) AS headway"
    )


@query("prepared_visits", f"SELECT trip_id, stop_sequence, stop_id, CAST(service_date AS varchar) AS service_date, route_id, route_id_old, service_id, direction_id, block_id, arr_s, dep_s, {r6s('stop_lat', 'stop_lon', 'headway')} FROM visits")
def _(w):
    return w.visits.selectExpr(
        "trip_id", "stop_sequence", "stop_id", "CAST(service_date AS string) AS service_date", "route_id", "route_id_old",
        "service_id", "direction_id", "block_id", *ARR, *r6("stop_lat", "stop_lon"),
        "round(mean_boarding_interval_seconds, 6) AS headway",
    )


@query("W4_trip_ends", "SELECT trip_id, route_id, block_id, start_stop_id, end_stop_id, start_s, end_s FROM trip_ends")
def _(w):
    return interline.trip_ends(w.located).selectExpr(
        "trip_id", "route_id", "block_id", "start_stop_id", "end_stop_id",
        "CAST(start_datetime AS bigint) AS start_s", "CAST(end_datetime AS bigint) AS end_s",
    )


@query("W5_legs", f"SELECT card_id, tap_s, line_id, stop_id, tap_s_next, line_id_next, stop_id_next, direction_id_next, {r6s('stop_lat', 'stop_lat_next')} FROM legs")
def _(w):
    return taps.pair_with_next(taps.locate_taps(w.taps, w.runs), S.leg_columns).selectExpr(
        "card_id", TAP_S, "line_id", "stop_id", "CAST(datetime_next AS bigint) AS tap_s_next", "line_id_next",
        "stop_id_next", "direction_id_next", *r6("stop_lat", "stop_lat_next"),
    )


@query("W6_G1_journey_ids", "SELECT card_id, tap_s, is_journey_end, journey_id FROM journeys")
def _(w):
    return journeys.build_journeys(w.rides, S.wait_minutes).select("card_id", "tap_s", "is_journey_end", "journey_id")


EVENT = ["journey_id", "card_id", "CAST(datetime AS bigint) AS dt_s", "event", "stop_id", "line_id"]
EVENT_SQL = "journey_id, card_id, dt_s, event, stop_id, line_id"


@query("W7_start_dates", f"SELECT {EVENT_SQL}, CAST(journey_start_date AS varchar) AS journey_start_date FROM rider_events")
def _(w):
    return w.events.selectExpr(*EVENT, "CAST(journey_start_date AS string) AS journey_start_date")


@query("W8_loops", f"SELECT {EVENT_SQL}, is_loop FROM looped")
def _(w):
    return w.looped.selectExpr(*EVENT, "is_loop")


@query("W9_event_types", f"SELECT {EVENT_SQL}, event_type FROM typed")
def _(w):
    return journeys.add_event_type(w.ride_events).selectExpr(*EVENT, "event_type")


@query("W10_event_sequences", f"SELECT {EVENT_SQL} FROM rider_events")
def _(w):
    return journeys.drop_odd_sequences(w.looped).selectExpr(*EVENT)


_SOME_ENDLESS = "CASE WHEN event_type = 'DESTINATION' AND stop_id = 3 THEN 'MID_JOURNEY' ELSE event_type END"


@query("W11_with_destination", f"""SELECT {EVENT_SQL} FROM (SELECT * REPLACE ({_SOME_ENDLESS} AS event_type) FROM looped) l
WHERE journey_id IN (SELECT journey_id FROM typed WHERE event_type = 'DESTINATION' AND stop_id IS DISTINCT FROM 3)""")
def _(w):
    # journeys that end at one stop lose their destination
    endless = w.looped.withColumn("event_type", F.expr(_SOME_ENDLESS))
    return journeys.drop_without_destination(endless).selectExpr(*EVENT)


@query("W12_look_ahead", f"""SELECT journey_id, card_id, dt_s, event, stop_id, line_id, stop_id_next, stop_id_next_next, event_type_next_next, trip_stop_id_next,
 {r4s('distance_to_next_stop', 'distance_to_next_next_stop', 'alighting_distance_to_next_stop')}, {r6s('confidence_next')},
 CAST(date_diff('day', CAST(make_timestamp(dt_s * 1000000) AS date), CAST(make_timestamp(dt2 * 1000000) AS date)) AS int) AS days_to_next_origin FROM ahead""")
def _(w):
    return compare.look_ahead(w.events, w.following).selectExpr(
        *EVENT, "stop_id_next", "stop_id_next_next", "event_type_next_next", "trip_stop_id_next",
        *r4("distance_to_next_stop", "distance_to_next_next_stop", "alighting_distance_to_next_stop"), *r6("confidence_next"),
        "days_to_next_origin",
    )


@query("W13_next_stops", "SELECT line_id, stop_id, direction_id, trip_stop_id_next FROM following")
def _(w):
    return profiles.next_stops(w.visits)


@query("W14_first_per_key", "SELECT trip_id, stop_sequence, stop_id FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY arr_s, stop_sequence) AS n FROM visits) x WHERE n = 1")
def _(w):
    return relational.first_per_key(w.visits, ["trip_id"], [F.col("arrive_datetime"), F.col("stop_sequence")]).select(
        "trip_id", "stop_sequence", "stop_id"
    )


@query("W15_distinct", "SELECT DISTINCT journey_id, line_id FROM rider_events")
def _(w):
    return w.events_by_journey.select("journey_id", "line_id").distinct()


# ---------------------------------------------------------------- interlining


@query("N1_blocks", "SELECT trip_id, block_id, route_id, route_id_next, end_stop_id, start_stop_id_next, interlines_with_trip_id FROM blocks")
def _(w):
    return interline.link_blocks(interline.trip_ends(w.located)).select(
        "trip_id", "block_id", "route_id", "route_id_next", "end_stop_id", "start_stop_id_next", "interlines_with_trip_id"
    )


@query("N2_J11_chains", "SELECT CAST(service_date AS varchar) AS service_date, trip_id, CAST(interlining_trip_id AS varchar) AS interlining_trip_id FROM chains")
def _(w):
    blocks = interline.link_blocks(interline.trip_ends(w.located))
    return interline.chain_trips(blocks).selectExpr(
        "CAST(service_date AS string) AS service_date", "trip_id", "CAST(interlining_trip_id AS string) AS interlining_trip_id"
    )


@query("N3_insert_chains", "SELECT CAST(trip_id AS varchar) AS trip_id, run_id, stop_sequence, stop_id, arr_s, dep_s, stop_type, trip_type FROM runs")
def _(w):
    return interline.insert_chains(w.visits, w.chains).selectExpr(
        "CAST(trip_id AS string) AS trip_id", "run_id", "stop_sequence", "stop_id", *ARR, "stop_type", "trip_type"
    )


@query("N3_without_interlining", "SELECT CAST(trip_id AS varchar) AS trip_id, run_id, stop_sequence, stop_id, arr_s, dep_s, stop_type, trip_type FROM c_runs")
def _(w):
    return interline.insert_chains(w.visits, None, allow=False).selectExpr(
        "CAST(trip_id AS string) AS trip_id", "run_id", "stop_sequence", "stop_id", *ARR, "stop_type", "trip_type"
    )


# ---------------------------------------------------------------- scoring

TAP_RUN = ["card_id", "tap_s", "run_id", "stop_id", "board_sequence"]


@query("A1_platform_boarding_probability", f"SELECT {', '.join(TAP_RUN)}, board_route, {r6s('boarding_probability')} FROM board_platform")
def _(w):
    return boarding.score_platform_boarding(w.platform).selectExpr(*TAP_RUN, "board_route", *r6("boarding_probability"))


@query("A2_onboard_boarding_probability", f"SELECT {', '.join(TAP_RUN)}, {r6s('boarding_probability')} FROM board_onboard")
def _(w):
    return boarding.score_onboard_boarding(w.onboard).selectExpr(*TAP_RUN, *r6("boarding_probability"))


@query("A2_in_array_form", f"SELECT {', '.join(TAP_RUN)}, {r6s('boarding_probability')} FROM board_onboard")
def _(w):
    return boarding.scored_onboard_candidates(w.tap_keys(False), w.runs, w.slice_seconds).selectExpr(*TAP_RUN, *r6("boarding_probability"))


@query("A3_transfer_walk", f"SELECT {', '.join(TAP_RUN)}, alight_sequence, {r4s('transfer_meters', 'transfer_seconds', 'walk_all_seconds')} FROM walked")
def _(w):
    return w.walked.selectExpr(*TAP_RUN, "alight_sequence", *r4("transfer_meters", "transfer_seconds", "walk_all_seconds"))


@query("A4_travel_times", f"SELECT {', '.join(TAP_RUN)}, alight_sequence, {r4s('travel_seconds', 'min_travel_seconds', 'max_travel_seconds')} FROM timed")
def _(w):
    return w.timed.selectExpr(*TAP_RUN, "alight_sequence", *r4("travel_seconds", "min_travel_seconds", "max_travel_seconds"))


@query("A4_alighting_probability", f"SELECT {', '.join(TAP_RUN)}, alight_sequence, {r6s('stop_probability', 'not_left_probability', 'alighting_probability')} FROM left_off")
def _(w):
    return w.scored.selectExpr(*TAP_RUN, "alight_sequence", *r6("stop_probability", "not_left_probability", "alighting_probability"))


@query("A5_chosen_rides", f"SELECT card_id, tap_s, run_id, stop_id, board_sequence, alight_stop_id, alight_sequence, alight_s, {r6s('confidence')} FROM chosen")
def _(w):
    best = alighting.best_stop_per_run(w.scored).repartition("card_id")
    return alighting.choose_alighting(alighting.add_confidence(best)).selectExpr(
        *TAP_RUN, "alight_stop_id", "alight_sequence", "alight_s", *r6("confidence")
    )


@query("A6_validity_score", f"SELECT journey_id, tap_s, {r6s('validity_score')} FROM valid")
def _(w):
    return w.valid.selectExpr("journey_id", "tap_s", *r6("validity_score"))


@query("A6_validity_whole_journey", f"""SELECT journey_id, tap_s, round(CASE WHEN d = 0 THEN 0 ELSE 1 / (1 + m / nullif(d, 0)) END, 6) AS validity_score
FROM (SELECT journey_id, tap_s, max(transfer_meters) OVER w AS m,
  2 * 6371000 * asin(sqrt(pow(sin((radians(first_value(stop_lat) OVER w) - radians(last_value(next_lat) OVER w)) / 2), 2)
   + cos(radians(first_value(stop_lat) OVER w)) * cos(radians(last_value(next_lat) OVER w))
   * pow(sin((radians(first_value(stop_lon) OVER w) - radians(last_value(next_lon) OVER w)) / 2), 2))) AS d
 FROM valid WINDOW w AS (PARTITION BY journey_id ORDER BY tap_s ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) x""")
def _(w):
    legs = journeys.split_journeys(w.judged)[0]
    return journeys.add_validity_score(legs, whole_journey=True).selectExpr("journey_id", "tap_s", *r6("validity_score"))


@query("A7_great_circle", """SELECT a.stop_id AS a, b.stop_id AS b, round(2 * 6371000 * asin(sqrt(pow(sin((radians(a.stop_lat) - radians(b.stop_lat)) / 2), 2)
 + cos(radians(a.stop_lat)) * cos(radians(b.stop_lat)) * pow(sin((radians(a.stop_lon) - radians(b.stop_lon)) / 2), 2))), 4) AS meters
FROM fx_stops a JOIN fx_stops b ON b.stop_id = a.stop_id + 1 AND b.release_date = a.release_date""")
def _(w):
    s = w.raw("stops")
    b = s.selectExpr("stop_id - 1 AS a", "stop_id AS b", "stop_lat AS b_lat", "stop_lon AS b_lon", "release_date")
    a = s.selectExpr("stop_id AS a", "stop_lat", "stop_lon", "release_date")
    d = great_circle_meters(F.col("stop_lat"), F.col("stop_lon"), F.col("b_lat"), F.col("b_lon"))
    return a.join(b, ["a", "release_date"]).select("a", "b", F.round(d, 4).alias("meters"))


# ---------------------------------------------------------------- journeys


@query("G2_judged_legs", "SELECT card_id, tap_s, journey_id, is_impossible, array_to_string(reasons, ';') AS reasons FROM judged")
def _(w):
    built = journeys.build_journeys(w.rides, S.wait_minutes)
    return journeys.judge_journeys(built, S.max_days_to_destination).selectExpr(
        "card_id", "tap_s", "journey_id", "is_impossible", "array_join(array_sort(reasons_for_impossibility), ';') AS reasons"
    )


@query("G3_journey_events", f"SELECT {EVENT_SQL}, direction_id, fare_category_description, {r6s('stop_lat', 'stop_lon', 'validity_score', 'confidence')} FROM ride_events")
def _(w):
    return w.ride_events.selectExpr(
        *EVENT, "direction_id", "fare_category_description", *r6("stop_lat", "stop_lon", "validity_score", "confidence")
    )


@query("G4_failed_events", f"SELECT {EVENT_SQL}, direction_id, CAST(service_date AS varchar) AS service_date, reasons, {r6s('stop_lat', 'stop_lon', 'confidence')} FROM failed_events")
def _(w):
    return journeys.failed_events(w.failed).selectExpr(
        *EVENT, "direction_id", "CAST(service_date AS string) AS service_date",
        "array_join(array_sort(reasons_for_impossibility), ';') AS reasons", *r6("stop_lat", "stop_lon", "confidence"),
    )


@query("G5_tag_mode", "SELECT card_id, tap_s, CASE WHEN line_id = 200 THEN 'platform' ELSE 'onboard' END AS mode, sha256(card_id || strftime(make_timestamp(tap_s * 1000000), '%Y-%m-%d %H:%M:%S')) AS tap_id FROM legs")
def _(w):
    return taps.tag_mode(w.legs).selectExpr("card_id", TAP_S, "mode", "tap_id")


@query("G6_use_alternatives", f"SELECT card_id, tap_s, stop_id_old, stop_id, {r6s('stop_lat', 'stop_lon')} FROM platform_taps")
def _(w):
    return boarding.use_alternatives(w.tap_keys(True), w.alternatives).selectExpr(
        "card_id", "tap_s", "stop_id_old", "stop_id", *r6("stop_lat", "stop_lon")
    )


@query("rider_events", f"SELECT {EVENT_SQL}, direction_id, event_type, is_loop, fare_category_description, CAST(journey_start_date AS varchar) AS journey_start_date, {r6s('stop_lat', 'stop_lon', 'validity_score', 'confidence')} FROM rider_events")
def _(w):
    return w.events.selectExpr(
        *EVENT, "direction_id", "event_type", "is_loop", "fare_category_description",
        "CAST(journey_start_date AS string) AS journey_start_date",
        *r6("stop_lat", "stop_lon", "validity_score", "confidence"),
    )


# ---------------------------------------------------------------- aggregations


_METRICS = """SELECT metric, round(value, 6) AS value FROM (
 SELECT 'N_SUCCESSFUL' AS metric, CAST(count(DISTINCT journey_id) AS double) AS value FROM rider_events
 UNION ALL SELECT 'N_FAILED', count(DISTINCT journey_id) FROM failed
 UNION ALL SELECT 'PERCENT_FAILED', floor(100.0 * b / (a + b)) FROM (SELECT (SELECT count(DISTINCT journey_id) FROM rider_events) AS a, (SELECT count(DISTINCT journey_id) FROM failed) AS b) q
 UNION ALL SELECT 'MEAN_CONFIDENCE', avg(confidence) FROM rider_events WHERE event = 'ALIGHTED'
 UNION ALL SELECT 'PERCENT_INTERLINE', floor(100.0 * count(DISTINCT CASE WHEN event LIKE '%INTERLINE%' THEN journey_id END) / count(DISTINCT journey_id)) FROM rider_events
 UNION ALL SELECT reason, count(*) FROM (SELECT DISTINCT service_date, journey_id, unnest(reasons) AS reason FROM failed) r GROUP BY reason) x"""


@query("R1_run_metrics", _METRICS)
def _(w):
    return metrics.run_metrics(w.events, w.failed).selectExpr("metric", *r6("value"))


@query("R2_mean_locations", f"SELECT stop_id, {r6s('stop_lat', 'stop_lon')} FROM places")
def _(w):
    return taps.mean_stop_locations(w.runs).selectExpr("stop_id", *r6("stop_lat", "stop_lon"))


@query("R3_stats", "SELECT journey_id, round(min(confidence), 6) AS confidence_min, round(max(confidence), 6) AS confidence_max, round(avg(confidence), 6) AS confidence_mean, round(sum(confidence), 6) AS confidence_sum, count(confidence) AS confidence_count FROM rider_events GROUP BY journey_id")
def _(w):
    return w.events.groupBy("journey_id").agg(*relational.stats("confidence")).selectExpr(
        "journey_id", *r6("confidence_min", "confidence_max", "confidence_mean", "confidence_sum"), "confidence_count"
    )


@query("R5_platform_lines_per_stop", "SELECT stop_id, count(DISTINCT line_id) AS n_platform_lines FROM following WHERE line_id IN (200, 100, 190, 90, 290) GROUP BY stop_id")
def _(w):
    return compare.platform_lines_per_stop(w.following)


def _disc(value: str, p: int) -> str:
    return f"quantile_disc({value}, {p / 100})"


@query("R6_confidence_quantiles", "SELECT is_single_stop_ride, count(*) AS n, " + ", ".join(f"round({_disc('confidence_next', p)}, 6) AS percentile_{p}" for p in range(0, 120, 20)) + " FROM lone WHERE is_platform = 'Y' GROUP BY is_single_stop_ride")
def _(w):
    df = compare.confidence_quantiles(w.lone.where("is_platform = 'Y'"), "is_single_stop_ride")
    return df.selectExpr("is_single_stop_ride", "n", *r6(*[f"percentile_{p}" for p in range(0, 120, 20)]))


@query("R7_confidence_spread", f"""SELECT is_single_stop_ride, is_platform, count(*) AS n, round(avg(confidence_next), 6) AS confidence_mean, round(stddev_samp(confidence_next), 6) AS confidence_std,
 round(avg(alighting_distance_to_next_stop), 4) AS distance_mean, round(stddev_samp(alighting_distance_to_next_stop), 4) AS distance_std FROM lone GROUP BY is_single_stop_ride, is_platform""")
def _(w):
    return compare.confidence_spread(w.lone).selectExpr(
        "is_single_stop_ride", "is_platform", "n", *r6("confidence_mean", "confidence_std"), *r4("distance_mean", "distance_std")
    )


_DESC = ["count", "mean", "std", "min", "max"] + [f"{p}%" for p in range(0, 100, 10)]


def _describe_sql(by: str, value: str, table: str, digits: int = 6) -> str:
    agg = {"count": f"CAST(count({value}) AS double)", "mean": f"avg({value})", "std": f"stddev_samp({value})",
           "min": f"min({value})", "max": f"max({value})"}
    agg |= {f"{p}%": f"quantile_cont({value}, {p / 100})" for p in range(0, 100, 10)}
    return " UNION ALL ".join(
        f"SELECT {by}, '{k}' AS statistic, round({v}, {digits}) AS figure FROM {table} GROUP BY {by}" for k, v in agg.items()
    )


@query("R8_describe_validity", _describe_sql("is_single_stop_ride", "validity_score", "profiles"))
def _(w):
    return profiles.describe(w.profiles, ["is_single_stop_ride"], "validity_score", [p / 100 for p in range(0, 100, 10)]).selectExpr(
        "is_single_stop_ride", "statistic", *r6("figure")
    )


@query("R8_describe_distance", _describe_sql("is_single_stop_ride", "feet", "(SELECT *, origin_destination_distance_meters * 3.3 AS feet FROM profiles) q", 4))
def _(w):
    feet = w.profiles.withColumn("feet", F.col("origin_destination_distance_meters") * 3.3)
    return profiles.describe(feet, ["is_single_stop_ride"], "feet", [p / 100 for p in range(0, 100, 10)]).selectExpr(
        "is_single_stop_ride", "statistic", *r4("figure")
    )


@query("R8_describe_confidence", _describe_sql("includes_platform", "confidence_min", "profiles"))
def _(w):
    return profiles.describe(w.profiles, ["includes_platform"], "confidence_min", [p / 100 for p in range(0, 100, 10)]).selectExpr(
        "includes_platform", "statistic", *r6("figure")
    )


@query("R9_medians_by_cutoff", "SELECT validity_score > 0.5 AS above, round(quantile_cont(journey_time_seconds, 0.5), 6) AS median_seconds FROM profiles GROUP BY 1")
def _(w):
    df = w.profiles.withColumn("above", F.expr("validity_score > 0.5"))
    return exact_quantiles(df, ["above"], "journey_time_seconds", [0.5]).selectExpr("above", "round(quantile, 6) AS median_seconds")


@query("R10_short_journeys", "SELECT is_single_stop_ride, count(*) AS n FROM profiles WHERE origin_destination_distance_meters * 3.3 < 2000 GROUP BY is_single_stop_ride")
def _(w):
    return w.profiles.where("origin_destination_distance_meters * 3.3D < 2000").groupBy("is_single_stop_ride").agg(F.count(F.lit(1)).alias("n"))


@query("R11_services_per_date", "SELECT date, array_to_string(list_sort(list(DISTINCT service_id)), ',') AS service_ids FROM fx_calendar_dates GROUP BY date")
def _(w):
    return schedule.services_per_date(w.raw("calendar_dates")).selectExpr("date", "array_join(service_ids, ',') AS service_ids")


# ---------------------------------------------------------------- sort, limit, set operations


@query("L1_top_per_group", "SELECT card_id, tap_s, stop_id FROM (SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY tap_s DESC, event_id) AS n FROM taps) x WHERE n <= 3")
def _(w):
    return relational.top_per_group(w.taps, ["card_id"], [F.col("datetime").desc(), F.col("event_id")], 3).selectExpr(
        "card_id", TAP_S, "STOP_ID AS stop_id"
    )


@query("L2_sample", "SELECT journey_id, card_id FROM (SELECT DISTINCT journey_id, card_id FROM profiles) p ORDER BY sha256('0|' || journey_id), journey_id LIMIT 25")
def _(w):
    rows = w.profiles.select("journey_id", "card_id").distinct()
    return profiles.sample_cards(rows, 25, ["journey_id"])


@query("L3_sorted_shares", f"SELECT line_id, n, round(percentage, 6) AS percentage FROM ({_SHARES.format('lone')}) q ORDER BY line_id DESC")
def _(w):
    return compare.line_shares(w.lone).orderBy(F.col("line_id").desc()).selectExpr("line_id", "n", *r6("percentage"))


@query("U1_union_missing_columns", "SELECT stop_id, line_id, event_id, trip_id FROM (SELECT stop_id, line_id, event_id, NULL AS trip_id FROM taps UNION ALL SELECT stop_id, NULL, NULL, trip_id FROM merged) x")
def _(w):
    a = w.taps.selectExpr("STOP_ID AS stop_id", "line_id", "EVENT_ID AS event_id")
    b = w.merged.select("stop_id", "trip_id")
    return relational.union_all(a, b).select("stop_id", "line_id", "event_id", "trip_id")


@query("U2_union_by_name", "SELECT stop_id, line_id, event FROM (SELECT stop_id, line_id, event FROM rider_events UNION ALL SELECT stop_id, line_id, event FROM failed_events) x")
def _(w):
    return relational.union_all(
        w.events.select("stop_id", "line_id", "event"), journeys.failed_events(w.failed).select("event", "line_id", "stop_id")
    )


@query("U3_array_sets", """SELECT journey_id, array_to_string(list_sort(list(DISTINCT line_id)), ',') AS lines,
 coalesce(array_to_string(list_sort(list(DISTINCT line_id) FILTER (line_id NOT IN (200, 100, 90, 190, 290))), ','), '') AS onboard_lines,
 bool_or(line_id = 100) AS has_100 FROM rider_events GROUP BY journey_id""")
def _(w):
    report = F.array(*[F.lit(i) for i in PLATFORM_REPORT_LINES])
    used = w.events.groupBy("journey_id").agg(F.collect_set("line_id").alias("l"))
    return used.select(
        "journey_id",
        F.array_join(F.array_sort("l"), ",").alias("lines"),
        F.array_join(F.array_sort(F.array_except("l", report)), ",").alias("onboard_lines"),
        F.array_contains("l", 100).alias("has_100"),
    )


# ---------------------------------------------------------------- journey analytics

PROFILE = {
    "K1_single_stop_rides": ["is_single_stop_ride"],
    "K2_leg_distances": ["leg_distance_meters_min", "leg_distance_meters_max", "total_journey_distance_traveled_meters"],
    "K3_leg_counts": ["n_legs"],
    "K4_transfer_distances": ["alighting_to_next_boarding_distance_meters_min", "alighting_to_next_boarding_distance_meters_max"],
    "K5_R4_lines_used": ["line_ids_used", "includes_platform", "is_platform_only"],
    "K6_confidences": ["confidence_min", "confidence_max", "confidence_mean"],
    "K7_origin_destination_distance": ["origin_destination_distance_meters"],
    "K8_origin_origin_distance": ["origin_origin_distance_meters"],
    "K9_inter_boarding_time": ["max_inter_boarding_time_seconds"],
    "K10_journey_time": ["journey_time_seconds"],
}
def _shown(name: str, array_join: bool) -> str:
    if "distance" in name:
        return r4(name)[0]
    if "confidence_" in name:
        return r6(name)[0]
    if name == "line_ids_used" and array_join:
        return "array_join(line_ids_used, ',') AS line_ids_used"
    return name


def _profile_query(name: str, columns: list[str]) -> None:
    oracle = "SELECT DISTINCT journey_id, " + ", ".join(_shown(c, False) for c in columns) + " FROM profiles"

    @query(name, oracle)
    def _(w):
        if name.startswith("K1_"):
            df = profiles.journey_profiles(w.events_by_journey, w.visits, one_row_per_journey=True)
        else:
            df = profiles.journey_figures(w.events)
        return df.selectExpr("journey_id", *[_shown(c, True) for c in columns])


for _name, _columns in PROFILE.items():
    _profile_query(_name, _columns)
_ALL = [c for cols in PROFILE.values() for c in cols]


@query("K11_J15_journey_profiles", f"SELECT journey_id, card_id, round(validity_score, 6) AS validity_score, {', '.join(_shown(c, False) for c in _ALL)} FROM profiles")
def _(w):
    return profiles.journey_profiles(w.events, w.visits).selectExpr(
        "journey_id", "card_id", "round(validity_score, 6) AS validity_score", *[_shown(c, True) for c in _ALL]
    )


def _pick(stratum: str) -> str:
    return f"""SELECT * FROM (SELECT card_id, journey_id, mode AS stratum,
   sha256('0|' || journey_id || coalesce('|' || CAST(CAST(floor(validity_score * 100) AS int) AS varchar), '')) AS h
 FROM profiles WHERE mode = '{stratum}' AND origin_origin_distance_meters IS NOT NULL ORDER BY h, journey_id LIMIT 25) z"""


@query("K12_stratified_samples", "SELECT p.stratum, e.journey_id, e.card_id, e.dt_s, e.event FROM rider_events e JOIN ("
       + " UNION ALL ".join(_pick(m) for m in ("platform_only", "onboard_only", "mixed")) + ") p ON p.card_id = e.card_id")
def _(w):
    # whole hundredths: their text is the same everywhere
    scored = w.profiles.withColumn("validity_score", F.floor(F.col("validity_score") * 100).cast("int"))
    return profiles.stratified_samples(scored, w.events).selectExpr("stratum", "journey_id", "card_id", "CAST(datetime AS bigint) AS dt_s", "event")


@query("K13_cutoff_counts", """SELECT CASE WHEN a.confidence > 0.15 THEN 'Y' ELSE 'N' END AS above_cutoff, count(*) AS n
FROM rider_events b JOIN rider_events a ON a.journey_id = b.journey_id
WHERE b.event = 'BOARDED' AND b.line_id IN (200, 100, 90, 190, 290) AND b.stop_id IN (3, 4, 5, 8, 9)
 AND a.event = 'ALIGHTED' AND a.line_id IN (200, 100, 90, 190, 290) GROUP BY 1""")
def _(w):
    return profiles.cutoff_counts(w.events, [3, 4, 5, 8, 9], PLATFORM_REPORT_LINES)


@query("K14_single_leg_summary", "SELECT is_single_stop_ride, alight_at_next_start_location, count(*) AS n_journeys, "
       + ", ".join(f"round(trunc({_disc('alighting_distance_to_next_stop', p)}) * 3.3, 6) AS percentile_distance_{p}" for p in range(0, 120, 20))
       + ", round(CAST(100.0 * count(*) / sum(count(*)) OVER () AS double), 4) AS percent_journeys FROM lone WHERE is_platform = 'Y' GROUP BY is_single_stop_ride, alight_at_next_start_location")
def _(w):
    df = compare.single_leg_summary(w.lone.where("is_platform = 'Y'"))
    feet = [c for c in df.columns if c.startswith("percentile_distance")]
    rest = [c for c in df.columns if c not in feet and c != "percent_journeys"]
    return df.selectExpr(*rest, *r6(*feet), "round(CAST(percent_journeys AS double), 4) AS percent_journeys")


@query("K14_single_leg_flags", "SELECT journey_id, is_null_journey, is_single_stop_ride, alight_at_next_start_location FROM lone")
def _(w):
    return w.lone.select("journey_id", "is_null_journey", "is_single_stop_ride", "alight_at_next_start_location")


@query("K16_confidence_by_lines", "SELECT n_platform_lines, count(*) AS n, " + ", ".join(f"round({_disc('confidence_next', p)}, 6) AS percentile_{p}" for p in range(0, 120, 20))
       + " FROM lone l JOIN (SELECT stop_id, count(DISTINCT line_id) AS n_platform_lines FROM following WHERE line_id IN (200, 100, 190, 90, 290) GROUP BY stop_id) q ON q.stop_id = l.stop_id GROUP BY n_platform_lines")
def _(w):
    return compare.confidence_by_platform_lines(w.lone, w.following).selectExpr(
        "n_platform_lines", "n", *r6(*[f"percentile_{p}" for p in range(0, 120, 20)])
    )


@query("J14_K15_platform_runs", f"""SELECT coalesce(c.line_id, f.line_id) AS line_id, c.n AS n_control, f.n AS n_fixed,
 round(c.mean_confidence, 6) AS mean_confidence_control, round(f.mean_confidence, 6) AS mean_confidence_fixed,
 round(c.percentage, 6) AS percentage_control, round(f.percentage, 6) AS percentage_fixed
FROM ({_SHARES.format("(SELECT * FROM c_lone WHERE line_id IN (200, 100, 90, 190, 290)) l")}) c
FULL JOIN ({_SHARES.format("(SELECT * FROM lone WHERE line_id IN (200, 100, 90, 190, 290) AND card_id IN (SELECT card_id FROM c_lone WHERE line_id IN (200, 100, 90, 190, 290))) l")}) f
ON f.line_id = c.line_id""")
def _(w):
    return compare.compare_runs(w.control_lone, w.lone).selectExpr(
        "line_id", "n_control", "n_fixed",
        *r6("mean_confidence_control", "mean_confidence_fixed", "percentage_control", "percentage_fixed"),
    )


_BY_LINES = "SELECT n_platform_lines, count(*) AS n, " + ", ".join(f"round({_disc('confidence_next', p)}, 6) AS percentile_{p}" for p in range(0, 120, 20)) + (
    " FROM {0} l JOIN (SELECT stop_id, count(DISTINCT line_id) AS n_platform_lines FROM following"
    " WHERE line_id IN (200, 100, 190, 90, 290) GROUP BY stop_id) q ON q.stop_id = l.stop_id GROUP BY n_platform_lines"
)
_BOTH = ["n", *(f"percentile_{p}" for p in range(0, 120, 20))]


@query("J14_K16_runs_by_lines", "SELECT c.n_platform_lines, " + ", ".join(f"c.{x} AS {x}_control, f.{x} AS {x}_fixed" for x in _BOTH)
       + f" FROM ({_BY_LINES.format('c_lone')}) c JOIN ({_BY_LINES.format('lone')}) f ON f.n_platform_lines = c.n_platform_lines")
def _(w):
    df = compare.compare_by_platform_lines(w.control_lone, w.lone, w.following)
    return df.selectExpr("n_platform_lines", "n_control", "n_fixed", *r6(*(f"{x}_{s}" for x in _BOTH[1:] for s in ("control", "fixed"))))


_PLATFORM = "line_id IN (200, 100, 90, 190, 290)"


def _checks_sql(lone: str, events: str) -> str:
    return f"""SELECT 'single_leg_journeys' AS check, count(DISTINCT journey_id) AS n FROM {lone}
 UNION ALL SELECT 'duplicate_events', count(*) FROM (SELECT 1 FROM {events} WHERE event IN ('BOARDED', 'ALIGHTED') GROUP BY card_id, dt_s, journey_id HAVING count(*) > 1) q
 UNION ALL SELECT 'same_stop_trips', count(*) FILTER (stop_id = stop_id_next) FROM {lone}"""


@query("K17_run_checks", _checks_sql("lone", "rider_events"))
def _(w):
    return compare.run_checks(w.lone, w.events)


@query("K17_platform_checks_of_both_runs", f"""SELECT 'control' AS run, * FROM ({_checks_sql(f"(SELECT * FROM c_lone WHERE {_PLATFORM}) x", f"(SELECT * FROM c_rider_events WHERE {_PLATFORM}) x")}) c
UNION ALL SELECT 'fixed' AS run, * FROM ({_checks_sql(f"(SELECT * FROM lone WHERE {_PLATFORM}) x", f"(SELECT * FROM rider_events WHERE {_PLATFORM}) x")}) f""")
def _(w):
    return compare.checks_of_runs({"control": (w.control_lone, w.control_events), "fixed": (w.lone, w.events)})


def _impact_sql(segment: str, above: str, modes: bool) -> str:
    stats = {
        "Number of Journeys": "CAST(count(*) AS double)",
        "Mean Number of Transfers": "avg(n_legs) - 1",
        "Median Distance (miles)": "quantile_cont(origin_destination_distance_meters * 3.3 / 5280, 0.5)",
        "Median Journey Time (minutes)": "quantile_cont(journey_time_seconds / 60, 0.5)",
    }
    if modes:
        stats |= {
            "Bus Only Journeys": "CAST(count(*) FILTER (NOT includes_platform) AS double)",
            "Bus and Platform Journeys": "CAST(count(*) FILTER (mode = 'mixed') AS double)",
            "Platform Only Journeys": "CAST(count(*) FILTER (mode = 'platform_only') AS double)",
            "Single Stop Rides": "CAST(count(*) FILTER (is_single_stop_ride) AS double)",
        }
    side = " UNION ALL ".join(
        f"SELECT {segment} AS segment, '{k}' AS statistic, {v} AS v, '{s}' AS side FROM profiles WHERE {cond} GROUP BY 1"
        for k, v in stats.items() for s, cond in (("all", "true"), ("above", above))
    )
    return f"""SELECT segment, statistic, round(a, 6) AS all_journeys, round(b, 6) AS above_cutoff, round((b - a) * 100 / nullif(a, 0), 6) AS percent_change
FROM (SELECT segment, statistic, max(v) FILTER (side = 'all') AS a, max(v) FILTER (side = 'above') AS b FROM ({side}) x GROUP BY segment, statistic) y"""


def _impact(df: DataFrame) -> DataFrame:
    return df.selectExpr("segment", "statistic", *r6("all_journeys", "above_cutoff", "percent_change"))


@query("K18_validity_impact", _impact_sql("'all'", "validity_score > 0.5", True))
def _(w):
    return _impact(profiles.validity_impact(w.profiles))


@query("K19_confidence_impact", _impact_sql("mode", "confidence_min > CASE WHEN mode = 'onboard_only' THEN 0.5 ELSE 0.2 END", False))
def _(w):
    return _impact(profiles.confidence_impact(w.profiles))


@query("K20_combined_impact", _impact_sql("'all'", "validity_score > 0.5 AND confidence_min > CASE WHEN includes_platform THEN 0.2 ELSE 0.5 END", True))
def _(w):
    return _impact(profiles.combined_impact(w.profiles))


@query("K21_score_histogram", "SELECT includes_platform, CAST(least(floor(confidence_min * 20), 20) + 1 AS int) AS bin, count(*) AS n FROM profiles GROUP BY 1, 2")
def _(w):
    return profiles.histogram(w.profiles, ["includes_platform"], "confidence_min", 0, 1, 20)


# ---------------------------------------------------------------- schedule


@query("X1_valid_dates", """SELECT service_id, len(d) AS n_dates, CAST(d[1] AS varchar) AS first_date, CAST(d[len(d)] AS varchar) AS last_date
FROM (SELECT service_id, list_transform(generate_series(strptime(CAST(start_date AS varchar), '%Y%m%d'), strptime(CAST(end_date AS varchar), '%Y%m%d'), INTERVAL 1 DAY), lambda x: CAST(x AS date)) AS d FROM fx_calendar) x""")
def _(w):
    return schedule.calendar_dates_of_services(w.raw("calendar")).selectExpr(
        "service_id", "CAST(size(valid_dates) AS bigint) AS n_dates", "CAST(valid_dates[0] AS string) AS first_date",
        "CAST(element_at(valid_dates, -1) AS string) AS last_date",
    )


@query("X2_all_releases", "SELECT DISTINCT stop_id, stop_lat, stop_lon FROM fx_stops")
def _(w):
    # a third release repeats the second
    stops = w.raw("stops")
    third = stops.where("release_date = date'2024-01-16'").withColumn("release_date", F.lit("2024-02-01").cast("date"))
    return schedule.all_releases(stops.unionByName(third))


@query("X3_active_services", "SELECT DISTINCT service_id FROM fx_calendar_dates WHERE exception_type = 1")
def _(w):
    return schedule.active_services(w.raw("calendar_dates"))


@query("X3_active_trips", "SELECT DISTINCT trip_id FROM (SELECT trip_id, CASE WHEN trip_id % 3 = 0 THEN 'B' ELSE service_id END AS service_id FROM fx_trips) t WHERE service_id IN (SELECT service_id FROM fx_calendar_dates WHERE exception_type = 1)")
def _(w):
    # a third of the trips belong to a service that is only taken away
    trips = w.raw("trips").withColumn("service_id", F.expr("CASE WHEN trip_id % 3 = 0 THEN 'B' ELSE service_id END"))
    return schedule.active_trips(w.raw("calendar_dates"), trips)


@query("X4_date_range", "SELECT service_id, date, exception_type FROM fx_calendar_dates WHERE date BETWEEN 20240105 AND 20240120")
def _(w):
    return schedule.between_dates(w.raw("calendar_dates"), "2024-01-05", "2024-01-20")


@query("X5_expand_schedule", """SELECT CAST(d.day AS varchar) AS service_date, count(*) AS n, sum(s.stop_sequence) AS sequences, min(s.arrival_time) AS first_arrival, count(DISTINCT s.stop_id) AS n_stops
FROM (SELECT DISTINCT service_id, strptime(CAST(date AS varchar), '%Y%m%d')::date AS day FROM fx_calendar_dates) d
JOIN fx_trips t ON t.service_id = d.service_id JOIN fx_stop_times s ON s.trip_id = t.trip_id
WHERE t.service_id IN (SELECT service_id FROM fx_calendar_dates WHERE exception_type = 1) GROUP BY 1""")
def _(w):
    out = schedule.expand_schedule(w.raw("calendar_dates"), w.raw("trips"), w.raw("stop_times"))
    return out.groupBy(F.col("service_date").cast("string").alias("service_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("stop_sequence").alias("sequences"),
        F.min("actual_arrive_time").alias("first_arrival"), F.count_distinct("stop_id").alias("n_stops"),
    )


# ---------------------------------------------------------------- sources and sinks


@query("S1_parquet_pattern", "SELECT event_id, stop_id FROM fx_taps")
def _(w):
    out = scratch(w)
    rows = w.raw("taps").select("event_id", "stop_id")
    rows.write.option("compression", "gzip").parquet(f"{out}/taps")
    rows.write.mode("append").option("compression", "snappy").parquet(f"{out}/taps")  # must not be read
    return readers.read_parquet(w.spark, f"{out}/taps", "*.gz.parquet")


@query("S2_S10_landed_feed", "SELECT trip_id, route_id, '2024-01-16' AS release_date FROM fx_trips")
def _(w):
    out = scratch(w)
    w.raw("trips").write.mode("overwrite").option("header", True).csv(f"{out}/text/trips.txt")
    schema = "trip_id int, route_id string, service_id string, direction_id int, block_id int"
    sinks.land_release(w.spark, f"{out}/text/trips.txt", f"{out}/feed", "trips", "2024-01-16", schema)
    return readers.read_feed(w.spark, f"{out}/feed", "trips", landed=True).selectExpr(
        "trip_id", "route_id", "CAST(RELEASE_DATE AS string) AS release_date"
    )


def release_files(w: World, df: DataFrame, folder: str, kind: str) -> None:
    """Parquet files of one kind in a release's folder, named after the kind."""
    parts = f"{scratch(w)}/{kind}"
    df.write.parquet(parts)
    path = w.spark._jvm.org.apache.hadoop.fs.Path
    files = path(parts).getFileSystem(w.spark._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for i, found in enumerate(files.globStatus(path(f"{parts}/*.parquet"))):
        files.rename(found.getPath(), path(f"{folder}/{i}-{kind}.parquet"))


@query("S2_feed_over_releases", """SELECT trip_id, CAST(t.release_date AS varchar) AS release_date, s.n_stops, s.latitudes FROM (
  SELECT trip_id, make_date(2023, 12, 15) AS release_date FROM fx_trips WHERE trip_id % 2 = 0 UNION ALL
  SELECT trip_id, make_date(2024, 1, 16) FROM fx_trips) t
JOIN (SELECT release_date, count(*) AS n_stops, round(sum(stop_lat), 6) AS latitudes FROM fx_stops GROUP BY 1) s ON s.release_date = t.release_date""")
def _(w):
    # two releases of two kinds each; the first lists only even trips
    out = scratch(w)
    for day, trips in (("2023-12-15", w.raw("trips").where("trip_id % 2 = 0")), ("2024-01-16", w.raw("trips"))):
        folder = f"{out}/RELEASE_DATE={day}"
        release_files(w, trips, folder, "trips")
        release_files(w, w.raw("stops").where(f"release_date = date'{day}'").drop("release_date"), folder, "stops")
    stops = readers.read_feed(w.spark, out, "stops").groupBy("RELEASE_DATE").agg(
        F.count(F.lit(1)).alias("n_stops"), F.round(F.sum("stop_lat"), 6).alias("latitudes")
    )
    return readers.read_feed(w.spark, out, "trips").join(stops, "RELEASE_DATE").selectExpr(
        "trip_id", "CAST(RELEASE_DATE AS string) AS release_date", "n_stops", "latitudes"
    )


@query("S3_csv_inferred", "SELECT event_id, line_id, stop_id FROM fx_taps")
def _(w):
    out = scratch(w)
    w.raw("taps").select("event_id", "line_id", "stop_id").write.mode("overwrite").options(header=True, compression="gzip").csv(f"{out}/csv")
    return readers.read_csv(w.spark, f"{out}/csv").selectExpr(
        "CAST(event_id AS bigint) AS event_id", "CAST(line_id AS int) AS line_id", "CAST(stop_id AS int) AS stop_id"
    )


@query("S4_csv_declared", "SELECT service_id, date, exception_type FROM fx_calendar_dates")
def _(w):
    out = scratch(w)
    sinks.write_csv(w.raw("calendar_dates"), f"{out}/dates")
    return readers.read_csv(w.spark, f"{out}/dates", readers.CALENDAR_DATES)


@query("S5_partitioned_sink", f"SELECT journey_id, event, dt_s, CAST(journey_start_date AS varchar) AS journey_start_date FROM rider_events")
def _(w):
    out = scratch(w)
    sinks.write_table(w.events, f"{out}/events", "journey_start_date")
    return readers.read_parquet(w.spark, f"{out}/events").selectExpr(
        "JOURNEY_ID AS journey_id", "EVENT AS event", "CAST(DATETIME AS bigint) AS dt_s", "CAST(JOURNEY_START_DATE AS string) AS journey_start_date"
    )


@query("S6_two_key_sink", "SELECT trip_id, stop_sequence, CAST(service_date AS varchar) AS service_date, CAST((arr_s // 3600) % 24 AS int) AS hour FROM visits")
def _(w):
    out = scratch(w)
    sinks.write_table(w.visits, f"{out}/visits", "service_date", "hour")
    return readers.read_parquet(w.spark, f"{out}/visits").selectExpr(
        "TRIP_ID AS trip_id", "STOP_SEQUENCE AS stop_sequence", "CAST(SERVICE_DATE AS string) AS service_date", "HOUR AS hour"
    )


@query("S7_metrics_sink", _METRICS)
def _(w):
    out = scratch(w)
    sinks.write_metrics(metrics.run_metrics(w.events, w.failed), f"{out}/metrics")
    told = w.spark.read.text(f"{out}/metrics").select(F.explode(F.from_json("value", "map<string,double>")).alias("metric", "value"))
    return told.selectExpr("metric", *r6("value"))


@query("S8_csv_export", "SELECT journey_id, event, dt_s FROM rider_events")
def _(w):
    out = scratch(w)
    sinks.write_csv(w.events.selectExpr("journey_id", "event", "CAST(datetime AS bigint) AS dt_s"), f"{out}/sample")
    return readers.read_csv(w.spark, f"{out}/sample", "journey_id string, event string, dt_s bigint")


@query("S9_gzip_parquet", "SELECT trip_id, CAST(interlining_trip_id AS varchar) AS interlining_trip_id FROM chains")
def _(w):
    out = scratch(w)
    sinks.write_table(w.chains, f"{out}/chains", "service_date", compression="gzip")
    return readers.read_parquet(w.spark, f"{out}/chains").selectExpr(
        "TRIP_ID AS trip_id", "CAST(INTERLINING_TRIP_ID AS string) AS interlining_trip_id"
    )
