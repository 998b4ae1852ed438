"""Inputs of the registered queries: the raw relations and the written steps of a run.

Each step is computed by Spark from the given tables, written once per session
and read by the queries that start there.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import FIXTURE_SETTINGS, fixture
from tapweave.config import PLATFORM_LINE
from tapweave.functions.stage import stage
from tapweave.operators import alighting, boarding, compare, interline, journeys, profiles, visits
from tapweave.plans import infer as plan
from tapweave.plans import prepare as prep

S = FIXTURE_SETTINGS


class World:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return fixture(self.spark, self.sf_dir, f"fx_{name}")

    @cached_property
    def taps(self) -> DataFrame:
        return stage(prep.prepare_taps(self.raw("taps"), S), "taps")

    @cached_property
    def scheduled(self) -> DataFrame:
        watch = Observation()
        scheduled = stage(
            prep.scheduled_visits(self.raw("stop_events"), self.raw("trips"), self.taps, S, watch=watch), "scheduled"
        )
        visits.require_watched(watch)
        return scheduled

    @cached_property
    def positions(self) -> DataFrame:
        return stage(prep.stop_positions(self.raw("stops"), self.taps), "positions")

    @cached_property
    def located(self) -> DataFrame:
        return prep.located_visits(self.scheduled, self.positions)

    @cached_property
    def merged(self) -> DataFrame:
        return stage(visits.merge_repeated_stops(self.located), "merged")

    @cached_property
    def visits(self) -> DataFrame:
        # not written: most readers need few columns, many no headways, and then these are not computed
        return prep.prepare_visits(self.scheduled, self.positions, S)

    @cached_property
    def chains(self) -> DataFrame:
        return stage(prep.prepare_chains(self.scheduled, S), "chains")

    @cached_property
    def prepared(self) -> prep.Prepared:
        return prep.Prepared(self.taps, self.visits, self.chains)

    @cached_property
    def prepared_once(self) -> prep.Prepared:
        """The same for two runs: what they read of the visits is written, so the headways are made once."""
        return prep.Prepared(self.taps, stage(self.visits.select(*plan.VISIT_COLUMNS), "visits"), self.chains)

    @cached_property
    def runs(self) -> DataFrame:
        prepared = self.__dict__.get("prepared_once", self.prepared)
        return stage(plan.chained_visits(prepared, self.taps, S), "runs")

    @cached_property
    def legs(self) -> DataFrame:
        return stage(plan.build_legs(self.taps, self.runs, S), "legs")

    @cached_property
    def alternatives(self) -> DataFrame:
        return boarding.platform_alternatives(self.runs, S.alternative_meters, S.extra_platform_stops)

    @cached_property
    def slice_seconds(self) -> int:
        return boarding.slice_seconds(self.runs)

    def tap_keys(self, platform: bool) -> DataFrame:
        mode = F.col("line_id") == PLATFORM_LINE
        return boarding.tap_keys(self.legs, mode if platform else ~mode)

    @cached_property
    def platform(self) -> DataFrame:
        return boarding.platform_candidates(self.tap_keys(True), self.runs, self.alternatives, self.slice_seconds)

    @cached_property
    def onboard(self) -> DataFrame:
        return boarding.onboard_candidates(self.tap_keys(False), self.runs, self.slice_seconds)

    @cached_property
    def candidates(self) -> DataFrame:
        return stage(plan.boarding_candidates(self.legs, self.runs, S), "candidates")

    @cached_property
    def reached(self) -> DataFrame:
        return plan.reached_stops(self.candidates, self.runs, S)

    @cached_property
    def walked(self) -> DataFrame:
        return alighting.add_transfer_walk(self.reached, S.walking_speed)

    @cached_property
    def timed(self) -> DataFrame:
        return alighting.add_travel_times(self.walked)

    @cached_property
    def scored(self) -> DataFrame:
        return alighting.add_alighting_probability(self.timed)

    @cached_property
    def rides(self) -> DataFrame:
        return journeys.attach_choices(self.legs, plan.choose_rides(self.candidates, self.runs, S))

    @cached_property
    def judged(self) -> DataFrame:
        rides = journeys.attach_choices(self.legs, plan.choose_rides(self.candidates, self.runs, S, narrow=True))
        return stage(plan.judge(rides, S), "judged")

    @cached_property
    def valid(self) -> DataFrame:
        return journeys.split_journeys(self.judged)[0]

    @cached_property
    def failed(self) -> DataFrame:
        return plan.failed_of(self.judged)

    @cached_property
    def ride_events(self) -> DataFrame:
        changes = interline.interline_events(self.valid, self.runs)
        return journeys.journey_events(self.valid, changes)

    @cached_property
    def looped(self) -> DataFrame:
        return journeys.tag_loops(journeys.add_event_type(self.ride_events), S.loop_meters)

    @cached_property
    def events_by_journey(self) -> DataFrame:
        """The rider events, not written, in the partitioning by journey of their windows: for a query that reads them once."""
        typed = journeys.add_event_type(self.ride_events.repartition("journey_id"))
        return journeys.add_start_date(journeys.drop_odd_sequences(journeys.tag_loops(typed, S.loop_meters)))

    @cached_property
    def events(self) -> DataFrame:
        return stage(self.events_by_journey, "events")

    @cached_property
    def following(self) -> DataFrame:
        return stage(profiles.next_stops(self.visits), "following")

    @cached_property
    def profiles(self) -> DataFrame:
        return stage(profiles.journey_profiles(self.events, self.visits, following=self.following), "profiles")

    def lone_of(self, events: DataFrame) -> DataFrame:
        return compare.single_leg_trips(compare.on_platform(compare.look_ahead(events, self.following)))

    @cached_property
    def lone(self) -> DataFrame:
        return stage(self.lone_of(self.events), "lone")

    @cached_property
    def control_events(self) -> DataFrame:
        """Rider events of a run without interlining."""
        return plan.infer(self.prepared_once, S.but(allow_interlining=False)).events

    @cached_property
    def control_lone(self) -> DataFrame:
        return stage(self.lone_of(self.control_events), "control_lone")


_worlds: dict[tuple[str, str], World] = {}


def world(spark: SparkSession, sf_dir: str) -> World:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _worlds:
        _worlds[key] = World(spark, sf_dir)
    return _worlds[key]
