"""Where did the rider get off? Candidate stops, probabilities, the choice."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tapweave.config import PLATFORM_LINE
from tapweave.functions.clock import epoch
from tapweave.functions.geo import great_circle_meters
from tapweave.functions.stage import noted, stage

# walking follows the street grid, not the straight line
GRID_FACTOR = 2**0.5


def _stops_ahead(visits: DataFrame) -> DataFrame:
    return visits.select(
        F.col("service_date").alias("a_date"),
        F.col("run_id").alias("a_run"),
        epoch("arrive_datetime").alias("alight_s"),
        epoch("departure_datetime").alias("alight_depart_s"),
        F.col("stop_id").alias("alight_stop_id"),
        F.col("stop_lat").alias("alight_lat"),
        F.col("stop_lon").alias("alight_lon"),
        F.col("stop_sequence").alias("alight_sequence"),
        F.col("route_id_old").alias("alight_route"),
        "trip_type",
    )


# More crowded runs than this are joined, not broadcast.
BROADCAST_RUNS = 1_000_000


def crowded_runs(
    boardings: DataFrame, visits: DataFrame, pairs: int = 1_000_000, watch: Observation | None = None
) -> DataFrame | None:
    """Runs with more than ``pairs`` pairs of boardings and stops, and the ``parts`` to divide them into; None without any.

    Counted at once, from the date and run columns of both written tables,
    combined ahead of the shuffle. The wide rows are not touched. ``watch`` notes
    the pairs of all runs, see ``run_tasks``.
    """
    keys = ["service_date", "run_id"]
    taps = boardings.where(F.col("run_id").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("taps"))
    stops = visits.groupBy(*keys).agg(F.count(F.lit(1)).alias("stops"))
    of_run = F.col("taps") * F.col("stops")
    matched = taps.join(stops, keys)
    if watch is not None:
        matched = matched.observe(watch, F.sum(of_run).alias("pairs"))
    parts = F.ceil(of_run / pairs).cast("int")
    counted = matched.select(
        F.col("service_date").alias("p_date"), F.col("run_id").alias("p_run"), parts.alias("parts")
    )
    crowded = stage(counted.where("parts > 1"), "crowded")
    size = crowded.count()
    if not size:
        return None
    return F.broadcast(crowded) if size <= BROADCAST_RUNS else crowded


def run_tasks(watch: Observation, pairs: int = 1_000_000) -> int:
    """Tasks for the runs ``crowded_runs`` has counted, one for every ``pairs`` pairs of boardings and stops."""
    return max(1, ceil((noted(watch).get("pairs") or 0) / pairs))


# Places that ``alighting_candidates`` adds when asked, and whether all boardings of a tap in a run are of one route and direction.
PLACES = ("tap_place", "stop_place", "one_way")


def alighting_candidates(
    boardings: DataFrame, visits: DataFrame, crowded: DataFrame | None = None, tasks: int | None = None, placed: bool = False
) -> DataFrame:
    """Later stops of the boarded run that are reached before the next tap.

    Both sides share only date and run, and the rows of one run stay together
    for the scoring that follows. Boardings without a run never match; they get
    a made-up key each, so that they spread instead of meeting under null.
    ``crowded`` runs are divided by card into parts, with their stops repeated
    for each part; what part a row belongs to is told by a broadcast, so no row is
    moved by date and run alone. The runs are dealt over ``tasks`` tasks: the few
    rows ahead of the join do not tell Spark how many come out of it.

    With ``placed`` the rows also have the ``PLACES``: the place of the tap among those of its run, and
    that of the stop in riding order. Both sides are sorted by them ahead of the join, so the
    rows come out of it nearly in the order of the windows over tap and run, which then compare two
    numbers instead of card, time and three columns of the stop.
    """
    stray = -1 - F.pmod(F.xxhash64("card_id", "datetime"), F.lit(2**31))
    left = boardings.drop("tap_s").withColumn("run_key", F.coalesce(F.col("run_id"), stray))
    right = _stops_ahead(visits)
    keys = ["service_date", "run_key"]
    on = (F.col("service_date") == F.col("a_date")) & (F.col("run_key") == F.col("a_run"))
    if crowded is None:
        left = left.withColumn("part", F.lit(0))
    else:
        of_left = (F.col("service_date") == F.col("p_date")) & (F.col("run_key") == F.col("p_run"))
        of_right = (F.col("a_date") == F.col("p_date")) & (F.col("a_run") == F.col("p_run"))
        parts = F.coalesce(F.col("parts"), F.lit(1))
        told = ("p_date", "p_run", "parts")
        left = left.join(crowded, of_left, "left").withColumn("part", F.pmod(F.hash("card_id"), parts)).drop(*told)
        right = right.join(crowded, of_right, "left").withColumn("a_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop(*told)
        keys.append("part")
        on = on & (F.col("part") == F.col("a_part"))
    on = (
        on
        & F.col("run_id").isNotNull()
        & (F.col("alight_s") > F.col("depart_s"))
        & (F.col("alight_s") > F.col("tap_s"))
        & (F.col("alight_s") <= F.col("next_s"))
    )
    # Partitioned ahead of the join, whatever join is chosen: the rows multiply
    # after this shuffle and stay in place for all windows of the run.
    def dealt_by(df: DataFrame, by: list[str]) -> DataFrame:
        return df.repartition(*by) if tasks is None else df.repartition(tasks, *by)

    dealt = dealt_by(left, keys)
    if placed:
        dealt = _with_tap_places(dealt)
        stop_keys = ["a_date", "a_run", "a_part"][: len(keys)]
        order = Window.partitionBy(*stop_keys).orderBy("alight_depart_s", "alight_s", "alight_sequence")
        right = dealt_by(right, stop_keys).withColumn("stop_place", F.dense_rank().over(order))
    dealt = dealt.withColumn("tap_s", epoch("datetime"))
    return dealt.join(right, on, "left").drop("a_date", "a_run", "a_part")


def _with_tap_places(boardings: DataFrame) -> DataFrame:
    """Boardings dealt by run with ``tap_place`` and ``one_way``; one sort serves both and the join that follows."""
    run = Window.partitionBy("service_date", "run_key", "part").orderBy("card_id", "datetime")
    tap = Window.partitionBy(*_TAP_RUN)
    one_way = F.lit(True)
    for c in ("board_route", "board_direction_id"):
        alike = F.min(c).over(tap).eqNullSafe(F.max(c).over(tap))
        known = F.count(c).over(tap)
        one_way = one_way & alike & ((known == 0) | (known == F.count(F.lit(1)).over(tap)))
    return boardings.withColumns({"tap_place": F.dense_rank().over(run), "one_way": one_way})


# What scores and choice per run read of a placed candidate.
SCORED_BY = (
    "service_date", "run_key", "part", *PLACES, "line_id", "run_id", "stop_id", "arrive_s", "board_sequence",
    "board_route", "board_direction_id", "boarding_probability", "alight_s", "alight_depart_s", "alight_sequence",
    "transfer_seconds",
)
# What confidence and choice read of the best stops per run.
CHOSEN_BY = (
    "card_id", "datetime", "line_id", "board_route", "board_direction_id", "boarding_probability",
    "alighting_probability", "min_travel_seconds", "alight_s", "run_id", "board_sequence", "alight_sequence", "stop_id",
)


def walk_seconds(meters: str, speed: float) -> Column:
    return F.col(meters) / speed


def add_transfer_walk(candidates: DataFrame, speed: float) -> DataFrame:
    """Walk from the alighting stop to the next tap, and from the boarding stop to it."""
    to_next = GRID_FACTOR * great_circle_meters(
        F.col("alight_lat"), F.col("alight_lon"), F.col("next_lat"), F.col("next_lon")
    )
    all_the_way = GRID_FACTOR * great_circle_meters(
        F.col("stop_lat"), F.col("stop_lon"), F.col("next_lat"), F.col("next_lon")
    )
    return candidates.withColumn("transfer_meters", to_next).withColumns(
        {
            "transfer_seconds": walk_seconds("transfer_meters", speed),
            "walk_all_seconds": all_the_way / speed,
        }
    )


# All stops considered for one tap and run. Date, run and part come first: the
# candidates are already partitioned by them, so no shuffle is needed.
_TAP_RUN = ["service_date", "run_key", "part", "card_id", "datetime"]
# The same for candidates with ``PLACES``.
_PLACED_TAP_RUN = ["service_date", "run_key", "part", "tap_place"]


def _is_placed(candidates: DataFrame) -> bool:
    return set(PLACES) <= set(candidates.columns)


def _tap_run(candidates: DataFrame) -> list[str]:
    return _PLACED_TAP_RUN if _is_placed(candidates) else _TAP_RUN


def _along_run(candidates: DataFrame):
    """Stops in riding order; one sort serves the travel times, the probabilities and the best score."""
    stop = ["stop_place"] if _is_placed(candidates) else ["alight_depart_s", "alight_s", "alight_sequence"]
    return Window.partitionBy(*_tap_run(candidates)).orderBy(*stop, "arrive_s", "board_sequence", "stop_id")


def add_travel_times(candidates: DataFrame) -> DataFrame:
    group = _along_run(candidates).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seconds = F.col("alight_s") - F.col("arrive_s") + F.col("transfer_seconds")
    return candidates.withColumn("travel_seconds", seconds).withColumns(
        {
            "min_travel_seconds": F.min("travel_seconds").over(group),
            "max_travel_seconds": F.max("travel_seconds").over(group),
        }
    )


def add_alighting_probability(candidates: DataFrame, allow_no_stops: bool = False) -> DataFrame:
    """Chance of getting off at a stop, times that of not having got off before.

    The stop chance is a Lorentz curve around the fastest stop. Stops without
    dwell have chance 0 unless ``allow_no_stops``.
    """
    t = F.col("travel_seconds") - F.col("min_travel_seconds")
    gamma = F.try_divide(F.lit(0.5), F.col("max_travel_seconds") - F.col("min_travel_seconds"))
    chance = F.try_divide(gamma * gamma, t * t + gamma * gamma)
    if not allow_no_stops:
        chance = F.when(F.col("alight_s") != F.col("alight_depart_s"), chance).otherwise(F.lit(0.0))
    earlier = _along_run(candidates).rowsBetween(Window.unboundedPreceding, -1)
    return candidates.withColumn("stop_probability", chance).withColumn(
        "not_left_probability",
        F.coalesce(F.product(1 - F.col("stop_probability")).over(earlier), F.lit(1.0)),
    ).withColumn("alighting_probability", F.col("stop_probability") * F.col("not_left_probability"))


def _preference(score: Column) -> list[Column]:
    return [
        score.desc_nulls_last(),
        F.col("alight_s").asc_nulls_first(),
        F.col("run_id").asc_nulls_first(),
        F.col("board_sequence").asc_nulls_first(),
        F.col("alight_sequence").asc_nulls_first(),
        F.col("stop_id").asc_nulls_first(),
    ]


def best_stop_per_run(candidates: DataFrame) -> DataFrame:
    """Reduce the stops of a run to the best one per tap, route and direction.

    Route choice weighs all stops of a route and direction alike, so the winner
    of the tap is among these rows. Without any travel time that weight may turn
    out null, and then arrival alone decides, so the first arrival is kept too.
    Still in the partitioning of the run: the many stop candidates are never
    shuffled. With ``PLACES``, rows below the best score of a tap that has one route and
    direction in the run are left out ahead of the sort by preference.
    """
    score = F.col("alighting_probability") * F.col("boarding_probability")
    order = Window.partitionBy(*_tap_run(candidates), "board_route", "board_direction_id").orderBy(*_preference(score))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    unweighed = (F.col("line_id") == PLATFORM_LINE) & F.col("min_travel_seconds").isNull()
    if _is_placed(candidates):
        along = _along_run(candidates).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        scored = candidates.withColumn("__score", score).withColumn("__top", F.max("__score").over(along))
        may_win = F.col("__score").eqNullSafe(F.col("__top")) | ~F.col("one_way") | F.coalesce(unweighed, F.lit(False))
        candidates = scored.where(may_win).drop("__score", "__top")
    arrival = F.when(unweighed, F.struct("alight_s", "board_sequence", "alight_sequence", "stop_id"))
    placed = candidates.withColumn("__arrival", arrival).withColumns(
        {"__n": F.row_number().over(order), "__first": F.min("__arrival").over(whole)}
    )
    return placed.where((F.col("__n") == 1) | (F.col("__arrival") == F.col("__first"))).drop(
        "__n", "__arrival", "__first"
    )


def add_confidence(candidates: DataFrame) -> DataFrame:
    """Overall confidence; taps before boarding also weigh the choice of route and direction.

    The weight of a route and direction counts once however many rows it has.
    """
    tap = Window.partitionBy("card_id", "datetime")
    route = Window.partitionBy("card_id", "datetime", "board_route", "board_direction_id").orderBy(
        *_preference(F.col("alighting_probability"))
    )
    whole = route.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # sorted by route within the tap first: the windows over the tap need no sort then. The fastest of the
    # tap is taken from the routes', or Spark would put its window, with a sort of its own, ahead.
    timed = candidates.withColumns(
        {
            "__place": F.row_number().over(route),
            "__route_fastest": F.min("min_travel_seconds").over(whole),
        }
    ).withColumn("__fastest", F.min("__route_fastest").over(tap))
    weighed = timed.withColumn("__utility", F.exp(F.try_divide(F.col("__fastest"), F.col("__route_fastest"))))
    once = F.when(F.col("__place") == 1, F.col("__utility"))
    summed = weighed.withColumn("__utilities", F.sum(once).over(tap))
    joint = F.col("alighting_probability") * F.col("boarding_probability")
    choice = F.try_divide(F.col("__utility"), F.col("__utilities"))
    return summed.withColumn(
        "confidence", F.when(F.col("line_id") == PLATFORM_LINE, joint * choice).otherwise(joint)
    ).drop("__fastest", "__route_fastest", "__place", "__utility", "__utilities")


def choose_alighting(candidates: DataFrame) -> DataFrame:
    """The most confident candidate of each tap; of equals the earliest arrival."""
    order = Window.partitionBy("card_id", "datetime").orderBy(*_preference(F.col("confidence")))
    return candidates.withColumn("__n", F.row_number().over(order)).where(F.col("__n") == 1).drop("__n")
