"""Prepared tables to rider events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tapweave.config import PLATFORM_LINE, Settings
from tapweave.functions.clock import epoch
from tapweave.functions.stage import stage
from tapweave.functions.windows import over_narrow
from tapweave.operators import alighting, boarding, interline, journeys, metrics, taps, visits
from tapweave.plans.prepare import Prepared


@dataclass(frozen=True)
class Inferred:
    events: DataFrame
    failed_events: DataFrame
    failed_legs: DataFrame
    metrics: DataFrame


# What the steps after the chains read of a visit; all else is left in the prepared table.
RUN_COLUMNS = (
    "service_date", "run_id", "stop_id", "stop_sequence", "route_id", "route_id_old", "direction_id",
    "arrive_datetime", "departure_datetime", "stop_lat", "stop_lon", "mean_boarding_interval_seconds",
    "trip_type", "stop_type",
)


# What they are made from; the shuffles of the visits carry nothing else.
VISIT_COLUMNS = ("trip_id", *(c for c in RUN_COLUMNS if c not in ("run_id", "trip_type", "stop_type")))


def chained_visits(prepared: Prepared, tapped: DataFrame, s: Settings) -> DataFrame:
    seen = visits.keep_tapped_dates(prepared.visits.select(*VISIT_COLUMNS), tapped)
    few = s.allow_interlining and interline.few_linked(prepared.chains)
    chained = interline.insert_chains(seen, prepared.chains, s.allow_interlining, s.keep_first_stop, few)
    return chained.select(*RUN_COLUMNS)


def build_legs(tapped: DataFrame, runs: DataFrame, s: Settings) -> DataFrame:
    # one row per stop: written, its size tells Spark whether to broadcast it
    places = stage(taps.mean_stop_locations(runs), "places") if s.staged else None
    return taps.pair_with_next(taps.locate_taps(tapped, runs, places), s.leg_columns)


def boarding_candidates(legs: DataFrame, runs: DataFrame, s: Settings) -> DataFrame:
    """Scored boarding candidates of both modes, narrow."""
    on_platform = boarding.tap_keys(legs, F.col("line_id") == PLATFORM_LINE)
    on_board = boarding.tap_keys(legs, F.col("line_id") != PLATFORM_LINE)
    alternatives = boarding.platform_alternatives(runs, s.alternative_meters, s.extra_platform_stops)
    if s.staged:  # pairs of near stops: their written size decides on a broadcast
        alternatives = stage(alternatives, "alternatives")
    # counted from the written visits
    width = boarding.slice_seconds(runs) if s.staged else boarding.SLICE_SECONDS
    platform = boarding.score_platform_boarding(boarding.platform_candidates(on_platform, runs, alternatives, width))
    return platform.unionByName(boarding.scored_onboard_candidates(on_board, runs, width))


# Columns that no later step reads; the multiplied rows are sorted without them.
_BEFORE_SCORING = ("walk_all_seconds", "next_lat", "next_lon", "stop_id_old", "trip_type")
_AFTER_SCORING = ("alight_depart_s", "travel_seconds", "max_travel_seconds", "stop_probability", "not_left_probability")
# Columns of the run's partitioning, and those that are computed again after the shuffle by card.
_BEFORE_CARD = ("run_key", "part", "tap_s", "transfer_seconds", *alighting.PLACES)


def reached_stops(candidates: DataFrame, runs: DataFrame, s: Settings, placed: bool = False) -> DataFrame:
    """Boardings with the stops ahead, in tasks of about ``Settings.task_pairs`` pairs each.

    Fewer tasks than cores are left to adaptive execution.
    """
    watch = Observation()
    crowded = alighting.crowded_runs(candidates, runs, s.task_pairs, watch)
    tasks = alighting.run_tasks(watch, s.task_pairs)
    few = tasks <= candidates.sparkSession.sparkContext.defaultParallelism
    return alighting.alighting_candidates(candidates, runs, crowded, None if few else tasks, placed)


def choose_rides(candidates: DataFrame, runs: DataFrame, s: Settings, narrow: bool = False) -> DataFrame:
    """One ride per tap; ``narrow`` is for rides whose columns all go on, see ``over_narrow``.

    Stops are joined, scored and reduced under the partitioning of the run;
    only the winners per run are shuffled on, by card.
    """
    walked = alighting.add_transfer_walk(reached_stops(candidates, runs, s, True), s.walking_speed).drop(*_BEFORE_SCORING)

    def best_per_run(placed: DataFrame) -> DataFrame:
        scored = alighting.add_alighting_probability(alighting.add_travel_times(placed), s.allow_no_stops)
        return alighting.best_stop_per_run(scored.drop(*_AFTER_SCORING))

    best = over_narrow(walked.drop("tap_s"), alighting.SCORED_BY, best_per_run).drop(*_BEFORE_CARD).repartition("card_id")

    def chosen_of(few: DataFrame) -> DataFrame:
        return alighting.choose_alighting(alighting.add_confidence(few))

    chosen = over_narrow(best, alighting.CHOSEN_BY, chosen_of) if narrow else chosen_of(best)
    return chosen.withColumns(
        {"tap_s": epoch("datetime"), "transfer_seconds": alighting.walk_seconds("transfer_meters", s.walking_speed)}
    )


def judge(rides: DataFrame, s: Settings) -> DataFrame:
    """Rides with journey, reasons and validity score.

    A journey is possible or impossible as a whole, so the scores of the possible ones are the
    same before the split, where the rides still lie by card.
    """
    built = journeys.build_journeys(rides, s.wait_minutes, narrow=True)
    judged = journeys.judge_journeys(built, s.max_days_to_destination, narrow=True)
    return journeys.add_validity_score(judged, narrow=True)


def failed_of(judged: DataFrame) -> DataFrame:
    return journeys.split_journeys(judged)[1].drop(*journeys.SCORE_COLUMNS)


def judged_legs(prepared: Prepared, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Legs with journey, reasons and score, and the visits they were matched to."""
    s = settings
    keep = stage if s.staged else (lambda df, _: df)
    tapped = taps.select_months(prepared.taps, "service_date", s.year_months)
    runs = keep(chained_visits(prepared, tapped, s), "runs")
    legs = keep(build_legs(tapped, runs, s), "legs")
    candidates = keep(boarding_candidates(legs, runs, s), "candidates")
    rides = journeys.attach_choices(legs, choose_rides(candidates, runs, s, narrow=True))
    return keep(judge(rides, s), "judged"), runs


def events_of(judged: DataFrame, runs: DataFrame, s: Settings) -> DataFrame:
    """Rider events before the sequence check."""
    possible, _ = journeys.split_journeys(judged)
    changes = interline.interline_events(possible, runs, s.allow_interlining)
    events = journeys.add_event_type(journeys.journey_events(possible, changes))
    return journeys.tag_loops(events, s.loop_meters)


def infer(prepared: Prepared, settings: Settings | None = None, strict: bool = True) -> Inferred:
    """Rider events, failed events and metrics.

    ``strict`` fails the run when a rider event has a null; the check rides on the
    write of the events, so nothing is computed twice. With ``Settings.staged`` off the
    events are not written, and the check computes them a second time.
    """
    s = settings or Settings()
    judged, runs = judged_legs(prepared, s)
    events = events_of(judged, runs, s)
    watch = Observation() if strict and s.staged else None
    if watch is not None:
        events = journeys.watch_complete(events, watch)
    elif strict:
        journeys.require_complete(events)
    events = journeys.add_start_date(journeys.drop_odd_sequences(events))
    if s.staged:
        events = stage(events, "events")
    if watch is not None:
        journeys.require_watched(watch)
    failed = failed_of(judged)
    return Inferred(events, journeys.failed_events(failed), failed, metrics.run_metrics(events, failed))
