"""Raw tables to prepared tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation

from tapweave.config import VISIT_SOURCE, Settings
from tapweave.functions.stage import stage
from tapweave.functions.windows import hot_groups
from tapweave.operators import interline, taps, visits


@dataclass(frozen=True)
class Prepared:
    taps: DataFrame
    visits: DataFrame
    chains: DataFrame


def prepare_taps(raw: DataFrame, s: Settings, strict: bool = True) -> DataFrame:
    df = taps.upper_case_columns(raw)
    if strict:
        taps.require_no_nulls(df, s.required_tap_columns)
    # The month is that of the last tap at a known stop. A day around it is kept for bursts that
    # cross its ends, so that only these partitions are read.
    latest = taps.latest_month(taps.drop_unknown_stops(df), "service_date")
    df = taps.select_months(df, "service_date", s.year_months, latest, margin=1)
    df = taps.fill_unknown_ticket(df)
    df = taps.alias_lines(df, s.line_aliases, "line_id")
    df = taps.parse_datetime(taps.drop_unknown_stops(df))
    df = taps.add_date(taps.drop_bursts(df, s.burst_seconds, s.slice_seconds))
    df = taps.select_months(df, "service_date", s.year_months, latest)
    return taps.tag_unwanted_operators(df, s.unwanted_operators)


def scheduled_visits(
    raw: DataFrame, trips: DataFrame, tapped: DataFrame, s: Settings, strict: bool = True, watch: Observation | None = None
) -> DataFrame:
    """Visits with trip data and times, and whether the trip's next visit is at the same stop (``is_repeated``).

    The join with the trips and the window over the trip share a shuffle by trip, of the
    given columns alone; all that is derived from them follows it. ``strict`` checks the trip data at once; with
    ``watch`` the check rides on the write of the visits, see ``visits.require_watched``.
    """
    df = visits.keep_tapped_dates(taps.upper_case_columns(raw), tapped)
    trips = taps.upper_case_columns(trips)
    if strict and watch is None:
        visits.require_trip_data(df, trips)
    hot = hot_groups(df, visits.TRIP_KEYS, s.window_rows)
    timed = visits.add_visit_times(visits.add_trip_data(df, trips, numbered=True))
    marked = visits.mark_repeated_stops(timed, hot, s.window_rows)
    return visits.numeric_routes(marked if watch is None else visits.watch_trip_data(marked, watch))


def stop_positions(stops: DataFrame, tapped: DataFrame) -> DataFrame:
    """Positions of the stops on the tapped dates."""
    return visits.stop_positions(taps.upper_case_columns(stops), tapped)


def located_visits(scheduled: DataFrame, positions: DataFrame) -> DataFrame:
    """The scheduled visits with source and positions, before any merging."""
    return visits.place_visits(visits.add_source(scheduled.drop("is_repeated"), VISIT_SOURCE), positions)


def prepare_visits(scheduled: DataFrame, positions: DataFrame, s: Settings) -> DataFrame:
    """Merged visits with headways on original routes, lines aliased after that.

    The shuffle for the headways has the merged visits without what is added after it.
    """
    # merging only takes visits away, so these are all groups that can be too large
    stops = hot_groups(scheduled, visits.HEADWAY_KEYS, s.window_rows)
    df = visits.add_headways(visits.drop_repeated_stops(scheduled), stops, s.window_rows)
    df = visits.add_hour(taps.alias_lines(df, s.line_aliases, "route_id"))
    return visits.place_visits(visits.add_source(df, VISIT_SOURCE), positions)


def prepare_chains(scheduled: DataFrame, s: Settings) -> DataFrame:
    ends = interline.trip_ends(scheduled)
    if s.staged:  # one row per trip
        ends = stage(ends, "ends")
    hot = hot_groups(ends, interline.BLOCK_KEYS, s.window_rows)
    blocks = interline.link_blocks(ends, hot, s.window_rows, s.null_blocks)
    return interline.chain_trips(blocks, hot, s.window_rows)


def prepare(
    raw_taps: DataFrame,
    raw_visits: DataFrame,
    trips: DataFrame,
    stops: DataFrame,
    settings: Settings | None = None,
    strict: bool = True,
) -> Prepared:
    """Clean taps, visits and the chains of interlining trips.

    ``strict`` runs the input checks, which fail the run on nulls in required
    tap columns, on trips without schedule data and on odd route ids.
    """
    s = settings or Settings()
    keep = stage if s.staged else (lambda df, _: df)
    tapped = keep(prepare_taps(raw_taps, s, strict), "taps")
    # used by both the visits and the chains
    watch = Observation() if strict and s.staged else None
    scheduled = keep(scheduled_visits(raw_visits, trips, tapped, s, strict, watch), "scheduled")
    if watch is not None:
        visits.require_watched(watch)
    # one row per stop and date: written, its size tells Spark whether to broadcast it
    positions = keep(stop_positions(stops, tapped), "positions")
    return Prepared(
        tapped,
        keep(prepare_visits(scheduled, positions, s), "visits"),
        keep(prepare_chains(scheduled, s), "chains"),
    )
