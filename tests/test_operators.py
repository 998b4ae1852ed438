"""Hand-made cases for single operators."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.world import World
from tapweave import Settings
from tapweave.functions.clock import service_clock, service_slice
from tapweave.functions.geo import great_circle_meters
from tapweave.functions.quantiles import exact_quantiles, quantile_columns
from tapweave.functions.stage import stage
from tapweave.operators import alighting, boarding, interline, journeys, relational, rules, schedule, taps, visits
from tapweave.plans.prepare import prepare_taps

T0 = datetime(2024, 1, 5, 8, 0, 0)
DAY = date(2024, 1, 5)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def col(df, name, order=None):
    return [r[name] for r in (df.orderBy(order) if order else df).collect()]


def epoch_of(ts):
    return int((ts - datetime(1970, 1, 1)).total_seconds())


# ------------------------------------------------------------------ taps


def test_burst_keeps_last_tap(spark):
    df = spark.createDataFrame([("a", at(s)) for s in (0, 10, 25, 60)], "card_id string, datetime timestamp")
    assert col(taps.drop_bursts(df, 20), "datetime", "datetime") == [at(25), at(60)]


def test_burst_across_slices_and_same_second(spark):
    rows = [("a", at(s), i) for i, s in enumerate((-5, 4, 899, 899, 905, 1795, 1815))]
    df = spark.createDataFrame(rows, "card_id string, datetime timestamp, event_id int")
    kept = taps.drop_bursts(df, 20, slice_seconds=900)
    assert col(kept, "event_id", "event_id") == [1, 4, 5, 6]
    plain = taps.drop_bursts(df, 20, slice_seconds=10**7)
    assert col(plain, "event_id", "event_id") == [1, 4, 5, 6]


def test_null_check_names_columns(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert taps.require_no_nulls(df, ["a"]) is df
    with pytest.raises(ValueError, match="b"):
        taps.require_no_nulls(df, ["a", "b"])


def test_alias_and_unwanted(spark):
    df = spark.createDataFrame([(90, "MAIN"), (4, None), (194, "PSC")], "line_id int, operatedby_description string")
    out = taps.tag_unwanted_operators(taps.alias_lines(df, {90: 200, 194: 193}, "line_id"), ["PSC"])
    assert sorted((r.line_id_old, r.line_id, r.is_unwanted_operator) for r in out.collect()) == [
        (4, 4, True), (90, 200, False), (194, 193, True)
    ]


def test_months(spark):
    df = spark.createDataFrame([(date(2023, 12, 31),), (date(2024, 1, 1),), (date(2024, 1, 31),)], "d date")
    assert taps.select_months(df, "d").count() == 2
    assert taps.select_months(df, "d", [(2023, 12)]).count() == 1
    with pytest.raises(ValueError):
        taps.select_months(df, "d", "all")


def test_bad_times_become_null(spark):
    df = spark.createDataFrame([("2024-01-05 08:00:00",), ("soon",)], "tap_time string")
    assert sorted(col(taps.parse_datetime(df), "datetime"), key=str) == [T0, None]


# ------------------------------------------------------------------ visits


def test_service_clock(spark):
    df = spark.createDataFrame(
        [(DAY, t) for t in ("26:15:03", "08:00:00", "48:00:00", "7:61:00", None, "x")], "d date, t string"
    )
    got = [r.v for r in df.select(service_clock("d", F.col("t")).alias("v")).collect()]
    assert got == [datetime(2024, 1, 6, 2, 15, 3), T0, None, None, None, None]


def test_service_slice_is_monotone_and_bounded(spark):
    day = epoch_of(datetime(2024, 1, 5))
    seconds = [day - 10**6, day, day + 899, day + 900, day + 10**7]
    df = spark.createDataFrame([(DAY, s) for s in seconds] + [(DAY, None)], "d date, s long")
    got = [r.v for r in df.select(service_slice(F.col("d"), F.col("s"), 900).alias("v")).collect()]
    assert got == [0, 0, 0, 1, 191, None]


def test_repeated_stop_keeps_last(spark):
    df = spark.createDataFrame(
        [(DAY, 1, i, stop, at(60 * i)) for i, stop in enumerate((7, 7, 8, None, None))],
        "service_date date, trip_id int, stop_sequence int, stop_id int, arrive_datetime timestamp",
    )
    assert col(visits.merge_repeated_stops(df), "stop_sequence", "stop_sequence") == [1, 2, 3, 4]


def headway_rows(arrivals):
    return [(1, 2, DAY, 0, 10 + i, i, at(a) if a is not None else None) for i, a in enumerate(arrivals)]


HEADWAY = "route_id int, stop_id int, service_date date, direction_id int, trip_id int, stop_sequence int, arrive_datetime timestamp"


@pytest.mark.parametrize(
    "arrivals, expected",
    [
        ((0, 600, 1200), [600.0] * 3),
        ((0, 30, 60), [60.0] * 3),
        ((0,), [None]),
        ((None, None, None, None, 0, 300, 900), [300.0, 300.0, 300.0, 300.0, 450.0, 450.0, 450.0]),
    ],
)
def test_headways(spark, arrivals, expected):
    df = visits.add_headways(spark.createDataFrame(headway_rows(arrivals), HEADWAY))
    assert col(df, "mean_boarding_interval_seconds", "stop_sequence") == expected


def test_nearest_release(spark):
    stops = spark.createDataFrame(
        [("5", date(2023, 12, 15), 1.0), ("5", date(2024, 1, 16), 2.0), ("5", date(2024, 1, 16), 2.5), ("6", date(2024, 1, 1), 9.0)],
        "stop_id string, release_date date, stop_lat double",
    ).withColumn("stop_lon", F.col("stop_lat"))
    days = [date(2023, 1, 1), date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 20)]
    v = spark.createDataFrame([(5, d) for d in days] + [(7, DAY)], "stop_id int, service_date date")
    out = visits.add_stop_locations(v, stops).orderBy("stop_id", "service_date")
    # 2023-12-31 is 16 days from both releases: the earlier one counts
    assert col(out, "stop_lat") == [1.0, 1.0, 2.0, 2.0, None]


def test_missing_trips_and_odd_routes_raise(spark):
    v = spark.createDataFrame([(1, DAY), (2, DAY)], "trip_id int, service_date date")
    schema = "trip_id int, route_id string, service_id string, direction_id int, block_id int"
    good = spark.createDataFrame([(1, "81a", "A", 0, 1), (2, "4", "A", 0, 1)], schema)
    assert visits.require_trip_data(v, good) is v
    with pytest.raises(ValueError, match="2024-01-05"):
        visits.require_trip_data(v, good.where("trip_id = 1"))
    with pytest.raises(ValueError, match="numeric"):
        visits.require_trip_data(v, good.replace("4", "X-4", "route_id"))


def test_source_column_once(spark):
    df = visits.add_source(spark.range(1), "S")
    with pytest.raises(ValueError):
        visits.add_source(df, "S")


# ------------------------------------------------------------------ interlining

BLOCK = "service_date date, block_id int, service_id string, trip_id int, route_id int, start_stop_id int, end_stop_id int, start_datetime timestamp"


def test_chain_of_three_and_a_lone_trip(spark):
    rows = [
        (DAY, 1, "A", 1, 10, 100, 101, at(0)),
        (DAY, 1, "A", 2, 20, 101, 102, at(100)),
        (DAY, 1, "A", 3, 30, 102, 103, at(200)),
        (DAY, 1, "A", 4, 40, 900, 901, at(300)),
        (DAY, 1, "A", 5, 40, 901, 902, at(400)),  # meets, but on the same route
    ]
    out = interline.chain_trips(interline.link_blocks(spark.createDataFrame(rows, BLOCK)))
    ids = {r.trip_id: int(r.interlining_trip_id) for r in out.collect()}
    assert ids[1] == ids[2] == ids[3] and ids[1] not in (1, 2, 3)
    assert ids[4] == 4 and ids[5] == 5


def chain_visits(spark):
    rows = [
        (DAY, 1, 1, 7, at(0), at(10)), (DAY, 1, 2, 8, at(100), at(110)),
        (DAY, 2, 1, 8, at(120), at(150)), (DAY, 2, 2, 9, at(300), at(310)),
    ]
    v = spark.createDataFrame(
        rows, "service_date date, trip_id int, stop_sequence int, stop_id int, arrive_datetime timestamp, departure_datetime timestamp"
    )
    chains = spark.createDataFrame([(DAY, 1, 99), (DAY, 2, 99)], "service_date date, trip_id int, n int").selectExpr(
        "service_date", "trip_id", "CAST(n AS decimal(38,0)) AS interlining_trip_id"
    )
    return v, chains


def test_chain_merges_meeting_stop(spark):
    out = interline.insert_chains(*chain_visits(spark)).orderBy("stop_sequence").collect()
    # the first stop of a chain is lost in parity mode
    assert [(r.stop_id, r.stop_sequence, r.stop_type) for r in out] == [(8, 1, "INTERLINE"), (9, 2, "SINGLE_LINE")]
    assert out[0].arrive_datetime == at(100) and out[0].departure_datetime == at(150)
    kept = interline.insert_chains(*chain_visits(spark), keep_first_stop=True)
    assert col(kept, "stop_id", "stop_sequence") == [7, 8, 9]


def test_few_linked_trips_move_no_visits(spark):
    """However large the written chains are, of which most trips are alone."""
    rows, chains = (stage(df, n) for df, n in zip(chain_visits(spark), ("visits", "chains")))
    assert interline.few_linked(chains) and not interline.few_linked(chains, 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        joined, told = (interline.insert_chains(rows, chains, few=few) for few in (False, True))
        assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in told._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, joined.collect())) == sorted(map(str, told.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_number_covers_64_bits(spark):
    df = spark.sql("SELECT CAST(x AS decimal(38,0)) AS x FROM VALUES ('5'), ('18446744073709551615'), ('9223372036854775808') AS t(x)")
    assert col(df.select(interline.run_number(F.col("x")).alias("n")), "n") == [5, -1, -(2**63)]


# ------------------------------------------------------------------ boarding

VISIT = (
    "service_date date, stop_id int, route_id int, route_id_old int, direction_id int, stop_sequence int, run_id long,"
    " arrive_datetime timestamp, departure_datetime timestamp, mean_boarding_interval_seconds double,"
    " stop_lat double, stop_lon double, trip_type string"
)


def visit(run, arrive, stop=1, line=4, depart=None, old=None, seq=1, lat=45.0):
    depart = arrive + 20 if depart is None else depart
    return (DAY, stop, line, old or line, 0, seq, run, at(arrive), at(depart), 600.0, lat, -122.0, "SINGLE_LINE")


def keys(spark, rows):
    schema = (
        "card_id string, datetime timestamp, tap_s long, next_s long, service_date date, line_id int, stop_id int,"
        " stop_lat double, stop_lon double, next_lat double, next_lon double"
    )
    made = [(c, at(t), epoch_of(at(t)), epoch_of(at(n)), DAY, line, stop, 45.0, -122.0, 45.1, -122.0) for c, t, n, line, stop in rows]
    return spark.createDataFrame(made, schema)


def test_onboard_takes_three_latest_arrivals(spark):
    v = spark.createDataFrame([visit(i, -60 * i) for i in range(5)] + [visit(9, 60)], VISIT)
    out = boarding.onboard_candidates(keys(spark, [("a", 0, 999, 4, 1), ("b", 0, 999, 5, 1)]), v)
    got = {(r.card_id, r.run_id) for r in out.collect()}
    # arrival at tap time counts; a tap without visits stays
    assert got == {("a", 0), ("a", 1), ("a", 2), ("b", None)}


def test_onboard_probability_both_ways(spark):
    v = spark.createDataFrame([visit(i, -90 * i) for i in range(4)], VISIT)
    k = keys(spark, [("a", 5, 999, 4, 1)])
    p = {r.run_id: r.boarding_probability for r in boarding.score_onboard_boarding(boarding.onboard_candidates(k, v)).collect()}
    q = {r.run_id: r.boarding_probability for r in boarding.scored_onboard_candidates(k, v).collect()}
    assert p.keys() == q.keys() and sum(p.values()) == pytest.approx(1)
    assert all(p[r] == pytest.approx(q[r], rel=1e-12) for r in p)


def pairs(spark, rows):
    return spark.createDataFrame(
        rows, "stop_id int, stop_id_alternative int, stop_lat_alternative double, stop_lon_alternative double"
    )


def test_platform_takes_two_next_departures_over_alternatives(spark):
    v = spark.createDataFrame(
        [visit(i, 60 * i - 20, line=200, old=90, depart=60 * i) for i in range(4)]
        + [visit(7, 70, stop=2, line=200, old=90, depart=90), visit(8, 500, stop=2, line=200, old=100)],
        VISIT,
    )
    alternatives = pairs(spark, [(1, 1, 45.0, -122.0), (1, 2, 45.0, -122.0)])
    out = boarding.platform_candidates(keys(spark, [("a", 60, 9999, 200, 1)]), v, alternatives)
    assert {(r.board_route, r.run_id) for r in out.collect()} == {(90, 1), (90, 7), (100, 8)}


def test_unserved_alternative_and_unknown_stop_stay_as_null(spark):
    v = spark.createDataFrame([visit(1, 100, line=200, old=90)], VISIT)
    alternatives = pairs(spark, [(1, 1, 45.0, -122.0), (1, 2, 45.5, -122.0)])
    taps_ = keys(spark, [("a", 0, 9999, 200, 1), ("b", 0, 9999, 200, 3)])
    out = boarding.platform_candidates(taps_, v, alternatives)
    got = {(r.card_id, r.stop_id, r.run_id) for r in out.collect()}
    assert got == {("a", 1, 1), ("a", 2, None), ("b", None, None)}


def test_alternatives_by_distance(spark):
    meter = 1 / 111194.92664
    rows = [visit(1, 0, stop=s, line=line, lat=45 + d * meter) for s, line, d in ((1, 200, 0), (2, 200, 152), (3, 200, 154), (7999, 4, 10))]
    out = boarding.platform_alternatives(spark.createDataFrame(rows, VISIT), 153, [7999])
    got = {(r.stop_id, r.stop_id_alternative) for r in out.collect()}
    assert got == {(1, 1), (1, 2), (1, 7999), (2, 1), (2, 2), (2, 3), (2, 7999), (3, 2), (3, 3), (3, 7999), (7999, 7999)}


def test_grid_holds_at_pole_and_antimeridian(spark):
    rows = [visit(1, 0, stop=1, line=200, lat=89.9999), visit(1, 0, stop=2, line=200, lat=89.9999)]
    df = spark.createDataFrame(rows, VISIT).withColumn("stop_lon", F.when(F.col("stop_id") == 1, 0.0).otherwise(180.0))
    assert boarding.platform_alternatives(df, 153).count() == 4
    df = df.withColumn("stop_lat", F.lit(10.0)).withColumn("stop_lon", F.when(F.col("stop_id") == 1, 179.9999).otherwise(-179.9999))
    assert boarding.platform_alternatives(df, 153).count() == 4


# ------------------------------------------------------------------ alighting


def candidates(spark, next_tap=1000):
    v = spark.createDataFrame([visit(1, 0, seq=1)], VISIT)
    return boarding.scored_onboard_candidates(keys(spark, [("a", 5, next_tap, 4, 1)]), v)


def test_alighting_band(spark):
    # not at the departure of the boarded visit, and up to the next tap inclusive
    stops = [visit(1, a, stop=10 + i, seq=2 + i) for i, a in enumerate((20, 21, 1000, 1001))]
    out = alighting.alighting_candidates(candidates(spark), spark.createDataFrame(stops, VISIT))
    assert sorted(col(out, "alight_stop_id")) == [11, 12]


def crowd(spark):
    """Boardings of one run by twenty cards, and its stops."""
    stops = spark.createDataFrame([visit(1, 100 * i, stop=10 + i, seq=2 + i) for i in range(1, 9)], VISIT)
    v = spark.createDataFrame([visit(1, 0, seq=1)], VISIT)
    k = keys(spark, [(f"c{i}", 5, 900, 4, 1) for i in range(20)])
    return stage(boarding.scored_onboard_candidates(k, v), "boardings"), stage(stops, "stops")


def test_hot_runs_give_the_same_candidates(spark):
    c, stops = crowd(spark)
    plain = alighting.alighting_candidates(c, stops)
    crowded = alighting.crowded_runs(c, stops, 40)
    assert crowded is not None and alighting.crowded_runs(c, stops) is None
    salted = alighting.alighting_candidates(c, stops, crowded)
    assert plain.select("part").distinct().count() == 1
    assert salted.select("part").distinct().count() > 1
    assert sorted(plain.drop("part").collect()) == sorted(salted.drop("part").collect())


def test_alighting_tasks_grow_with_the_pairs(spark):
    from tapweave.plans.infer import reached_stops

    c, stops = crowd(spark)
    plain = alighting.alighting_candidates(c, stops).drop("part")
    dealt = reached_stops(c, stops, Settings(task_pairs=10))
    pairs = c.join(stops.select("service_date", "run_id"), ["service_date", "run_id"]).count()
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert pairs > 100 and f"{-(-pairs // 10)}), REPARTITION_BY_NUM" in plan
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.drop("part").collect()))


def test_boardings_without_any_run_have_one_task(spark):
    from tapweave.plans.infer import reached_stops

    c, stops = crowd(spark)
    lost = stage(c.withColumn("run_id", F.lit(None).cast("long")), "lost")
    for few in (lost, c.where("card_id = ''")):
        assert reached_stops(few, stops, Settings()).count() == few.count()


def test_first_arrival_wins_when_the_route_weight_is_null(spark):
    # no position at the next tap: a stop without dwell scores 0, the rest null,
    # and the weight of the route makes all of them null
    v = spark.createDataFrame([visit(1, 0, line=200, old=90, depart=30)], VISIT)
    k = keys(spark, [("a", 5, 1000, 200, 1)]).withColumn("next_lat", F.lit(None).cast("double"))
    c = boarding.score_platform_boarding(boarding.platform_candidates(k, v, pairs(spark, [(1, 1, 45.0, -122.0)])))
    stops = [visit(1, 200, stop=9, seq=2), visit(1, 400, stop=10, seq=3, depart=400)]
    reached = alighting.alighting_candidates(c, spark.createDataFrame(stops, VISIT))
    scored = alighting.add_alighting_probability(alighting.add_travel_times(alighting.add_transfer_walk(reached, 1.5)))
    full = alighting.choose_alighting(alighting.add_confidence(scored))
    short = alighting.choose_alighting(alighting.add_confidence(alighting.best_stop_per_run(scored)))
    assert col(full, "alight_stop_id") == col(short, "alight_stop_id") == [9]


def test_single_stop_has_no_probability(spark):
    out = alighting.alighting_candidates(candidates(spark), spark.createDataFrame([visit(1, 500, stop=9, seq=2)], VISIT))
    timed = alighting.add_travel_times(alighting.add_transfer_walk(out, 1.5))
    assert col(alighting.add_alighting_probability(timed), "alighting_probability") == [None]


def test_stops_without_dwell_count_only_when_allowed(spark):
    stops = [visit(1, 200, stop=9, seq=2, depart=200), visit(1, 400, stop=10, seq=3), visit(1, 600, stop=11, seq=4)]
    out = alighting.alighting_candidates(candidates(spark), spark.createDataFrame(stops, VISIT))
    timed = alighting.add_travel_times(alighting.add_transfer_walk(out, 1.5))
    strict = col(alighting.add_alighting_probability(timed), "stop_probability", "alight_s")
    free = col(alighting.add_alighting_probability(timed, allow_no_stops=True), "stop_probability", "alight_s")
    assert strict[0] == 0 and free[0] == 1.0 and strict[1:] == free[1:]


# ------------------------------------------------------------------ journeys


def ride_rows(spark, rides):
    """(card, tap, alight, next, headway) with no walking."""
    schema = "card_id string, datetime timestamp, alight_s long, next_s long, board_headway double, transfer_seconds double"
    e = lambda x: None if x is None else epoch_of(at(x))
    return spark.createDataFrame([(c, at(t), e(a), e(n), h, 0.0) for c, t, a, n, h in rides], schema)


def test_journeys_end_on_long_waits(spark):
    rides = [
        ("a", 0, 500, 1000, 600.0),      # waits 500 of 900: goes on
        ("a", 1000, 2000, 3000, 900.0),  # waits 1000 of 900: ends
        ("a", 3000, 3500, 20000, 900.0), # more than two hours: ends
        ("a", 20000, None, 21000, 900.0),# unknown wait: ends
        ("a", 21000, 21100, 21200, None),
    ]
    out = journeys.build_journeys(ride_rows(spark, rides), 15).orderBy("datetime").collect()
    assert [r.is_journey_end for r in out] == [False, True, True, True, True]
    ids = [r.journey_id for r in out]
    assert ids[0] == ids[1] and len(set(ids)) == 4


def test_every_rule_has_a_text_once(spark):
    texts = [t for t, _ in rules.impossible_rules(7)]
    assert len(texts) == len(set(texts)) == 20


EVENTS = "card_id string, journey_id string, datetime timestamp, event string, stop_id int, line_id int, stop_lat double, stop_lon double"


def ride_events(spark, names, lats=None):
    lats = lats or [45.0] * len(names)
    rows = [("a", "j", at(10 * i), n, i, 4, lat, -122.0) for i, (n, lat) in enumerate(zip(names, lats))]
    return spark.createDataFrame(rows, EVENTS)


def test_event_types_skip_interlines(spark):
    names = ["BOARDED", "INTERLINE_STARTED", "INTERLINE_ENDED", "ALIGHTED", "BOARDED", "ALIGHTED"]
    out = journeys.add_event_type(ride_events(spark, names))
    assert col(out, "event_type", "datetime") == ["ORIGIN", "MID_JOURNEY", "MID_JOURNEY", "MID_JOURNEY", "MID_JOURNEY", "DESTINATION"]


@pytest.mark.parametrize(
    "names, kept",
    [
        (["BOARDED", "ALIGHTED", "BOARDED", "ALIGHTED"], 4),
        (["BOARDED", "BOARDED", "ALIGHTED", "ALIGHTED"], 0),
        (["BOARDED", "INTERLINE_STARTED", "INTERLINE_ENDED", "ALIGHTED"], 4),
        (["BOARDED"], 0),
    ],
)
def test_event_pairs(spark, names, kept):
    assert journeys.drop_odd_sequences(ride_events(spark, names)).count() == kept


def test_destination_filter_and_loop(spark):
    typed = journeys.add_event_type(ride_events(spark, ["BOARDED"]))
    assert journeys.drop_without_destination(typed).count() == 0
    for meters, loop in ((60, True), (61.5, False)):
        df = ride_events(spark, ["BOARDED", "ALIGHTED"], [45.0, 45.0 + meters / 111194.92664])
        assert set(col(journeys.tag_loops(df, 61), "is_loop")) == {loop}


# ------------------------------------------------------------------ the rest


def test_great_circle(spark):
    df = spark.sql("SELECT 0D AS a, 0D AS b, 0D AS c, 180D AS d, CAST(NULL AS double) AS n")
    r = df.select(
        great_circle_meters(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("half"),
        great_circle_meters(F.col("a"), F.col("b"), F.col("c"), F.col("n")).alias("none"),
        great_circle_meters(F.col("a"), F.col("b"), F.col("a"), F.col("b")).alias("zero"),
    ).first()
    assert r.half == pytest.approx(3.14159265358979 * 6371000) and r.none is None and r.zero == 0


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = {"a": rng.normal(size=997), "b": np.repeat([1.0, 5.0], [300, 3]), "c": np.array([7.0])}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None)]
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    out = exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", probs)
    got = {(r.g, r.prob): r.quantile for r in out.collect()}
    assert len(got) == 15
    for g, vs in values.items():
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(vs, p), rel=1e-12)


def test_union_needs_two(spark):
    with pytest.raises(ValueError):
        relational.union_all(spark.range(1))


def test_calendar(spark):
    df = spark.createDataFrame([("A", 20240130, 20240202), ("B", 20240102, 20240101)], "service_id string, start_date int, end_date int")
    got = {r.service_id: r.valid_dates for r in schedule.calendar_dates_of_services(df).collect()}
    assert got["A"] == [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 2)] and got["B"] == []


def test_legs_without_candidates_stay(spark):
    from tapweave.operators.journeys import attach_choices

    legs = spark.sql(
        "SELECT * FROM VALUES ('A', timestamp'2024-01-01 08:00:00', 4, 1), ('A', CAST(NULL AS timestamp), 4, 2),"
        " ('B', timestamp'2024-01-01 09:00:00', CAST(NULL AS int), 3) t(card_id, datetime, line_id, stop_id)"
    )
    chosen = spark.sql(
        "SELECT 'A' AS card_id, timestamp'2024-01-01 08:00:00' AS datetime, CAST(NULL AS int) AS stop_id, 7 AS run_id"
    )
    out = attach_choices(legs, chosen)
    assert sorted(out.columns) == ["card_id", "datetime", "line_id", "run_id", "stop_id"]
    got = {(r.card_id, r.line_id, r.stop_id, r.run_id) for r in out.collect()}
    assert got == {("A", 4, None, 7), ("A", 4, 2, None), ("B", None, 3, None)}


def test_latest_month_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "by_date")
    spark.sql("SELECT id, date_add(date'2024-01-01', CAST(id AS int)) AS day FROM range(70)").write.partitionBy("day").parquet(path)
    latest = taps.select_months(spark.read.parquet(path), "day")
    assert latest.count() == 10
    plan = latest._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "NestedLoop" not in plan and "subquery" in scan.split("PartitionFilters")[1].split("PushedFilters")[0].lower()


def test_taps_are_pruned_to_the_latest_month(spark, tmp_path):
    """Of a table partitioned by date only the month and a day on both sides are read, and bursts over its ends are seen."""
    path = str(tmp_path / "taps")
    rows = [
        (i, f"C{i % 5}", f"2024-{1 + i // 30:02d}-{1 + i % 28:02d} 10:00:00", 200, 7, f"2024-{1 + i // 30:02d}-{1 + i % 28:02d}") for i in range(90)
    ]
    # the last tap of the month before goes with its successor; a tap without a stop does not make the month
    rows += [(100, "C9", "2024-02-29 23:59:55", 200, 7, "2024-02-29"), (101, "C9", "2024-03-01 00:00:05", 200, 7, "2024-03-01"),
             (102, "C8", "2024-05-01 00:00:05", 200, -1, "2024-05-01")]
    frame = spark.createDataFrame(rows, "event_id int, card_id string, tap_time string, line_id int, stop_id int, service_date string")
    frame = frame.withColumns({
        "service_date": F.to_date("service_date"), "direction_id": F.lit(0), "operatedby_description": F.lit("x"),
        "transaction_ticket_description": F.lit(None).cast("string"), "fare_category_description": F.lit("Adult"),
    })
    frame.write.partitionBy("service_date").parquet(path)
    table = spark.read.parquet(path)
    for months in (-1, ((2024, 3),)):
        out = prepare_taps(table, Settings(year_months=months), strict=False)
        got = {r[0] for r in out.select("event_id").collect()}
        assert got == {r[0] for r in rows if r[5].startswith("2024-03")}
        scans = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x and "card_id" in x]
        assert len(scans) == 1 and "service_date" in scans[0].split("PartitionFilters")[1].split("PushedFilters")[0]
    february = prepare_taps(table, Settings(year_months=((2024, 2),)), strict=False)
    assert 100 not in {r[0] for r in february.select("event_id").collect()}


def test_choosing_rides_moves_no_row_by_run_alone(spark):
    """Crowded runs are told by a broadcast; the only shuffles of boardings and stops are by run and part."""
    c, stops = crowd(spark)
    crowded = alighting.crowded_runs(c, stops, 40)
    plan = alighting.alighting_candidates(c, stops, crowded)._jdf.queryExecution().executedPlan().toString()
    shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert shuffles and all("part" in x.split("hashpartitioning(")[1].split(")")[0] for x in shuffles)


def shuffles_of(df):
    """Lines of the plan that shuffle by keys."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x]


def rider_events(spark, cards=3):
    schema = (
        "card_id string, journey_id string, datetime timestamp, stop_id int, line_id int, direction_id int, stop_lat double,"
        " stop_lon double, event string, event_type string, validity_score double, confidence double"
    )
    rows = []
    for c in range(cards):
        for j in range(2):
            for k, (event, kind) in enumerate((("BOARDED", "ORIGIN"), ("ALIGHTED", "DESTINATION"))):
                rows.append((f"c{c}", f"j{c}{j}", at(5000 * j + 600 * k), 1 + k + j, 4, 0, 45.0 + k / 10, -122.0, event, kind, 0.5, 0.9))
    return stage(spark.createDataFrame(rows, schema), "rider_events")


def test_figures_and_look_ahead_shuffle_once_by_card(spark):
    from tapweave.operators import compare, profiles

    events = rider_events(spark)
    figures = profiles.journey_figures(events)
    assert len(shuffles_of(figures)) == 1 and "(card_id" in shuffles_of(figures)[0]
    got = {r["journey_id"]: (r["n_legs"], r["journey_time_seconds"], r["max_inter_boarding_time_seconds"]) for r in figures.collect()}
    assert got == {f"j{c}{j}": (1, 600, 5000 if j == 0 else None) for c in range(3) for j in range(2)}
    schema = "line_id int, stop_id int, direction_id int, trip_stop_id_next int"
    following = stage(spark.createDataFrame([(4, 1, 0, 2)], schema), "following")
    ahead = compare.look_ahead(events, following)
    by_events = [x for x in shuffles_of(ahead) if "card_id" in x]
    assert len(by_events) == 1 and "journey_id" not in by_events[0].split(")")[0]
    lone = compare.single_leg_trips(ahead).collect()
    assert {(r["journey_id"], r["is_single_stop_ride"]) for r in lone} == {(f"j{c}0", "Y") for c in range(3)}


def test_attached_rides_stay_by_card(spark):
    legs = stage(spark.createDataFrame([("a", at(0), 1, 4), ("a", at(90), 2, 4), ("b", at(5), 1, None)], "card_id string, datetime timestamp, stop_id int, line_id int"), "legs")
    ride = "card_id string, datetime timestamp, stop_id int, board_headway double, next_s long, alight_s long, transfer_seconds double"
    chosen = stage(spark.createDataFrame([("a", at(0), 7, 600.0, 90, 60, 5.0), ("a", at(90), None, None, None, None, None)], ride), "chosen")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = journeys.build_journeys(journeys.attach_choices(legs, chosen.repartition("card_id")), 15)
        assert len(shuffles_of(built)) == 2, "one of either side of the join"
        got = {(r["card_id"], r["datetime"], r["stop_id"], r["alight_s"]) for r in built.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {("a", at(0), 7, 60), ("a", at(90), None, None), ("b", at(5), 1, None)}


def test_scores_of_possible_journeys_do_not_need_the_split(spark):
    from tapweave.plans import infer as plan

    schema = (
        "card_id string, journey_id string, datetime timestamp, stop_lat double, stop_lon double, stop_lat_next double,"
        " stop_lon_next double, transfer_meters double, is_impossible boolean, reasons_for_impossibility array<string>"
    )
    rows = [("a", f"j{j}", at(60 * i), 45.0, -122.0, 45.1 + i / 10, -122.0, 10.0 * (3 - i) if i else None, j == 1, ["x"] * (j == 1)) for j in range(2) for i in range(3)]
    judged = stage(spark.createDataFrame(rows, schema), "judged")
    scored = journeys.add_validity_score(judged)
    before, after = journeys.add_validity_score(journeys.split_journeys(judged)[0]), journeys.split_journeys(scored)[0]
    assert before.columns == after.columns and sorted(map(str, before.collect())) == sorted(map(str, after.collect()))
    failed = journeys.split_journeys(judged)[1]
    assert plan.failed_of(scored).columns == failed.columns and plan.failed_of(scored).count() == failed.count() == 3


def test_null_check_rides_on_the_write(spark):
    from pyspark.sql import Observation

    events = rider_events(spark)
    broken = events.withColumn("stop_lat", F.when(F.col("journey_id") != "j00", F.col("stop_lat")))
    for rows, bad in ((events, None), (events.where("stop_id > 99"), None), (broken, "stop_lat")):
        watch = Observation()
        written = stage(journeys.add_start_date(journeys.drop_odd_sequences(journeys.watch_complete(rows, watch))), "events")
        assert written.count() == rows.count()
        if bad is None:
            journeys.require_watched(watch)
        else:
            with pytest.raises(ValueError, match=f"nulls found in {bad}$"):
                journeys.require_watched(watch)


def test_slices_shrink_as_stops_are_served_more_densely(spark):
    def served(times, line, old):
        rows = [visit(i, 7200 * i // times, line=line, old=old, depart=7200 * i // times + 5) for i in range(times)]
        return spark.createDataFrame(rows, VISIT)

    assert boarding.slice_seconds(served(24, 4, 4)) == 900
    assert boarding.slice_seconds(served(24, 4, 4).where("run_id < 0")) == 900
    thin, dense = (boarding.slice_seconds(served(n, 4, 4)) for n in (1_000, 10_000))
    assert thin == 346 and dense == 35
    visits_, taps_ = served(300, 4, 4), keys(spark, [(f"c{t}", t, 9999, 4, 1) for t in range(-50, 7500, 83)])
    one = boarding.scored_onboard_candidates(taps_, visits_)
    for width in (1, 7, 900):
        other = boarding.scored_onboard_candidates(taps_, visits_, width)
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    visits_, taps_ = served(300, 200, 90), keys(spark, [(f"c{t}", t, 9999, 200, 1) for t in range(-50, 7500, 83)])
    near = pairs(spark, [(1, 1, 45.0, -122.0)])
    one = boarding.platform_candidates(taps_, visits_, near)
    for width in (1, 7):
        other = boarding.platform_candidates(taps_, visits_, near, width)
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_quantile_bins_are_even_whatever_the_tail(spark):
    from tapweave.functions.quantiles import BINS, binned_values

    values = [float(i) for i in range(20_000)] + [10.0**k for k in range(5, 300)]
    frame = spark.createDataFrame([(v,) for v in values], "v double").withColumn("g", F.lit(1))
    sizes = [r["count"] for r in binned_values(frame, ["g"], "v").groupBy("__bin").count().collect()]
    assert max(sizes) <= 2 * len(set(values)) / BINS
    got = {r["prob"]: r["quantile"] for r in exact_quantiles(frame, ["g"], "v", [0.0, 0.25, 0.5, 0.999, 1.0]).collect()}
    assert got == {p: pytest.approx(float(np.quantile(values, p))) for p in got}


def test_discrete_quantiles_are_exact_at_any_size(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(size=30_000), np.repeat(1.5, 9_000), [7.0]])
    frame = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 3.0), ("b", None)], "g string, v double")
    row = {r["g"]: r for r in quantile_columns(frame, ["g"], "v", [0.0, 0.2, 0.5, 0.9, 1.0], "q").collect()}
    ordered = np.sort(values)
    for percent in (0, 20, 50, 90, 100):
        assert row["a"][f"q_{percent}"] == ordered[max(1, int(np.ceil(len(ordered) * percent / 100))) - 1]
        assert row["b"][f"q_{percent}"] == 3.0


def test_locations_per_stop_and_date(spark):
    releases = [(s, date(2024, 1, d), 45.0 + d, -122.0 - s) for s in (1, 2) for d in (2, 10, 11, 30)] + [(3, date(2023, 1, 1), 1.0, 1.0)]
    stops = spark.createDataFrame(releases, "stop_id int, release_date date, stop_lat double, stop_lon double")
    seen = spark.createDataFrame([(i, 1 + i % 4, date(2024, 1, 1 + i % 31)) for i in range(200)], "trip_id int, stop_id int, service_date date")
    plain = visits.add_stop_locations(seen, stops)
    by_date = visits.add_stop_locations(seen, stops, seen)
    assert by_date.columns == plain.columns and sorted(map(str, by_date.collect())) == sorted(map(str, plain.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = visits.add_stop_locations(seen, stops, seen)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [x for x in plan.splitlines() if "Exchange hashpartitioning(" in x and "stop_id" in x and "service_date" in x], plan



def test_departures_are_dealt_once_and_ranked_in_pairs(spark):
    """Visits by date, stop and line for windows and join; what was found goes on by tap, two departures to a row."""
    v = stage(spark.createDataFrame([visit(i, 60 * i, line=200) for i in range(5)], VISIT), "visits")
    k = stage(keys(spark, [("a", 5, 999, 200, 1), ("b", 70, 999, 200, 1)]), "keys")
    near = stage(pairs(spark, [(1, 1, 45.0, -122.0)]), "near")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = shuffles_of(boarding.score_platform_boarding(boarding.platform_candidates(k, v, near)))
        on_board = shuffles_of(boarding.scored_onboard_candidates(k, v))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [x for x in lines if "slice" in x or "board_route" in x], lines
    assert len([x for x in lines if "hashpartitioning(v_date" in x]) == 1, lines
    assert len([x for x in lines if "hashpartitioning(card_id" in x and "REPARTITION_BY_COL" in x]) == 1, lines
    # ahead of the structs of the window, not behind them
    assert len([x for x in on_board if "hashpartitioning(v_date" in x and "REPARTITION_BY_COL" in x]) == 1, on_board


def test_legs_are_dealt_before_they_are_paired(spark):
    t = stage(spark.createDataFrame([("a", at(0), 1), ("a", at(60), 2)], "card_id string, datetime timestamp, stop_id int"), "taps")
    legs = taps.pair_with_next(t, ("datetime", "stop_id"))
    lines = shuffles_of(legs)
    assert len(lines) == 1 and "REPARTITION_BY_COL" in lines[0], lines
    assert sorted((r.stop_id, r.stop_id_next) for r in legs.collect()) == [(1, 2), (2, None)]


def test_rides_by_card_carry_no_columns_of_the_run(spark):
    from tapweave.plans.infer import choose_rides

    c, stops = crowd(spark)
    chosen = choose_rides(c, stops, Settings())
    by_card = [x for x in shuffles_of(chosen) if "hashpartitioning(card_id" in x]
    assert len(by_card) == 1 and not {"run_key", "part"} & set(chosen.columns)
    rows = chosen.collect()
    assert len(rows) == 20 and all(r.tap_s == epoch_of(r.datetime) for r in rows)
    assert all(r.transfer_seconds == r.transfer_meters / Settings().walking_speed for r in rows)


def test_lines_of_journeys_need_one_shuffle(spark):
    """Events dealt by journey ahead of their windows, as the query on lines has them."""
    class Rides(World):
        ride_events = stage(rider_events(spark).drop("event_type"), "rides")

    events = Rides(spark, "").events_by_journey
    lines = shuffles_of(events.select("journey_id", "line_id").distinct())
    assert len(lines) == 1 and "hashpartitioning(journey_id" in lines[0], lines
