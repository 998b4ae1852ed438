"""What the comparisons of two runs move and sort, and that it gives the rows of the plain forms."""

import random
import types

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from checks.world import World
from tapweave import Settings
from tapweave.functions.stage import stage
from tapweave.operators import alighting, boarding, journeys, visits
from tests.test_operators import VISIT, at, crowd, keys, shuffles_of, visit


def two_way_crowd(spark):
    """Taps with up to three boardings of a run, of one route or two, and runs with stops at one time, without dwell or departure."""
    rng = random.Random(3)
    times = [(run, seq, 60 * seq + rng.choice((0, 60, 60, 200))) for run in range(1, 3) for seq in range(1, 15)]
    def line(run, seq):
        return 72 if run % 2 and seq > 4 else 4

    served = [visit(run, a, stop=rng.randrange(1, 6), seq=seq, old=line(run, seq), depart=rng.choice((a, a + 20))) for run, seq, a in times]
    stops = spark.createDataFrame(served, VISIT).withColumns(
        {
            "stop_lat": F.lit(45.0) + (F.col("stop_id") % 4) / 50,
            "departure_datetime": F.when(F.col("stop_sequence") % 5 != 0, F.col("departure_datetime")),
        }
    )
    v = spark.createDataFrame([visit(run, a, stop=1 + seq % 2, seq=seq, old=line(run, seq)) for run, seq, a in times if seq < 8], VISIT)
    k = keys(spark, [(f"c{i}", rng.randrange(0, 500), rng.randrange(500, 1200), 4, 1 + i % 2) for i in range(60)])
    k = k.withColumn("next_lat", F.when(F.hash("card_id") % 7 != 0, F.col("next_lat") + 0.01))
    return stage(boarding.scored_onboard_candidates(k, v), "boardings"), stage(stops, "stops")


def chosen_plainly(c, stops, s):
    """Rides chosen from all stops of all runs, without places and without the best stop per run."""
    reached = alighting.add_transfer_walk(alighting.alighting_candidates(c, stops), s.walking_speed)
    scored = alighting.add_alighting_probability(alighting.add_travel_times(reached))
    return alighting.choose_alighting(alighting.add_confidence(scored))


@pytest.mark.parametrize("pairs", [1_000_000, 20])
def test_placed_candidates_choose_the_same_rides(spark, pairs):
    from tapweave.plans.infer import choose_rides

    c, stops = two_way_crowd(spark)
    s = Settings(task_pairs=pairs)
    ways = alighting.alighting_candidates(c, stops, placed=True).where("run_id IS NOT NULL")
    assert {r.one_way for r in ways.select("one_way").distinct().collect()} == {True, False}
    shown = ["card_id", "datetime", "run_id", "stop_id", "board_sequence", "alight_stop_id", "alight_sequence", "confidence"]
    plain = sorted(map(str, chosen_plainly(c, stops, s).select(*shown).collect()))
    for narrow in (False, True):
        quick = choose_rides(c, stops, s, narrow).select(*shown).collect()
        assert len(quick) == 60 and sorted(map(str, quick)) == plain


def test_pairs_are_moved_in_few_columns(spark):
    """Windows over pairs of boardings and stops carry what they do not read as one column, and the taps have one sort less."""
    from tapweave.plans.infer import choose_rides

    c, stops = crowd(spark)
    chosen = choose_rides(c, stops, Settings())
    plan = chosen._jdf.queryExecution().executedPlan().toString().splitlines()
    by_stop = [x for x in plan if "Sort [" in x and "stop_place" in x]
    assert len(by_stop) == 1 and "card_id" not in by_stop[0] and any("AS __rest" in x for x in plan)
    assert len([x for x in plan if "Sort [card_id" in x]) == 2, plan


def test_judging_needs_one_sort_by_journey(spark):
    from tapweave.plans.infer import judge

    schema = "card_id string, datetime timestamp, datetime_next timestamp, service_date date, line_id int, stop_id int, stop_id_next int, is_unwanted_operator boolean, board_route int, run_id long"
    numbers = ("tap_s", "next_s", "alight_s", "arrive_s", "alight_stop_id")
    doubles = ("stop_lat", "stop_lon", "stop_lat_next", "stop_lon_next", "alight_lat", "alight_lon", "board_headway", "transfer_seconds", "transfer_meters", "confidence", "boarding_probability", "alighting_probability")
    schema += "".join(f", {c} long" for c in numbers) + "".join(f", {c} double" for c in doubles)
    rows = [("a", at(60 * i), at(60 * i + 60), None, 4, 1, 2, False, 4, 7, *[60 * i] * 5, *[45.0 + i] * 12) for i in range(3)]
    rides = stage(spark.createDataFrame(rows, schema), "rides")
    judged = judge(rides, Settings())
    sorts = [x for x in judged._jdf.queryExecution().executedPlan().toString().splitlines() if "Sort [" in x and "journey_id" in x]
    assert len(sorts) == 1, sorts
    plain = journeys.add_validity_score(journeys.judge_journeys(journeys.build_journeys(rides, 15), 7))
    assert judged.columns[: len(rides.columns)] == rides.columns and set(judged.columns) == set(plain.columns)
    assert sorted(map(str, judged.collect())) == sorted(map(str, plain.select(judged.columns).collect()))


def test_following_stops_need_one_shuffle_by_trip(spark):
    from tapweave.operators import profiles

    schema = "trip_id int, stop_sequence int, service_date date, arrive_datetime timestamp, stop_id int, route_id_old int, direction_id int"
    rows = [(t, q, at(86_400 * d).date(), at(86_400 * d + 60 * q), q + 1 - d, 4, 0) for t in (1, 2) for q in range(3) for d in range(2)]
    following = profiles.next_stops(stage(spark.createDataFrame(rows, schema), "visits"))
    by_trip = [x for x in shuffles_of(following) if "trip_id" in x]
    assert len(by_trip) == 1, by_trip
    assert sorted(map(tuple, following.collect()), key=str) == [(4, 1, 0, 2), (4, 2, 0, 3), (4, 3, 0, None)]


def test_two_runs_make_the_headways_once(spark, monkeypatch):
    from checks import world

    class Two(World):
        taps, chains = None, None
        visits = spark.range(3).selectExpr(*[f"id AS {c}" for c in world.plan.VISIT_COLUMNS], "id AS other")

    read = []
    monkeypatch.setattr(world.plan, "chained_visits", lambda prepared, tapped, s: read.append(prepared.visits) or prepared.visits)
    monkeypatch.setattr(world.plan, "infer", lambda prepared, s: read.append(prepared.visits) or types.SimpleNamespace(events=None))
    w = Two(spark, "")
    assert w.control_events is None and w.runs.count() == 3
    assert read[0] is read[1] and "Scan parquet" in read[0]._jdf.queryExecution().executedPlan().toString()
    Two(spark, "").runs
    assert read[2] is Two.visits


def test_clocks_and_routes_are_read_once(spark):
    from tapweave.plans.prepare import scheduled_visits

    stops = spark.createDataFrame([(7, "1", 1, "25:00:01", "xx", at(0).date()), (8, "z", 1, "07:60:00", "08:00:00", at(0).date())], "trip_id int, stop_id string, stop_sequence int, actual_arrive_time string, actual_departure_time string, service_date date")
    trips = spark.createDataFrame([(7, "81a", "A", 0, 1), (8, "4", "A", 0, 1)], "trip_id int, route_id string, service_id string, direction_id int, block_id int")
    tapped = spark.createDataFrame([(at(0).date(),)], "service_date date")
    watch = Observation()
    out = scheduled_visits(stage(stops, "stops"), stage(trips, "trips"), stage(tapped, "taps"), Settings(), watch=watch)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 2 and plan.count("regexp_replace(") == 1, plan
    assert "__route" not in out.columns and not [c for c in out.columns if c.startswith("__")]
    rows = {r["TRIP_ID"]: r for r in stage(out, "scheduled").collect()}
    visits.require_watched(watch)
    assert (rows[7].route_id, rows[7].stop_id, rows[7].departure_datetime, rows[8].stop_id, rows[8].arrive_datetime) == (81, 1, None, None, None)
    assert rows[7].arrive_datetime.hour == 1 and rows[8].departure_datetime.hour == 8


def test_narrow_steps_keep_columns_and_rows(spark):
    from tapweave.functions.windows import over_narrow

    df = spark.createDataFrame([("a", 1, None, 2.5), ("a", 2, "y", None), ("b", 1, "z", 0.5)], "K string, place int, text string, v double")
    step = lambda few: few.withColumn("n", F.count("place").over(Window.partitionBy("k"))).where("place < 2").drop("place")
    narrow, plain = over_narrow(df, ("k", "place"), step), step(df)
    assert narrow.columns == plain.columns == ["K", "text", "v", "n"]
    assert sorted(map(str, narrow.collect())) == sorted(map(str, plain.collect()))
    assert over_narrow(df, df.columns, step).columns == plain.columns
