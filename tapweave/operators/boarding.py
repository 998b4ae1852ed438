"""Which vehicle did the tap board? Candidate visits and their probability."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapweave.config import PLATFORM_LINE
from tapweave.functions.clock import DAY_SECONDS, epoch, service_slice
from tapweave.functions.geo import great_circle_meters, sphere_cell

# Taps and visits meet in slices of the day of at most this length, see ``slice_seconds``.
SLICE_SECONDS = 900
# Mean gaps between vehicles that a slice is long.
GAPS_PER_SLICE = 4

# What a candidate keeps of the visit that was boarded.
_BOARDED = {
    "board_route": "route_id_old",
    "board_direction_id": "direction_id",
    "board_sequence": "stop_sequence",
    "board_headway": "mean_boarding_interval_seconds",
    "run_id": "run_id",
}


def platform_alternatives(visits: DataFrame, meters: float, extra_stops: Sequence[int] = ()) -> DataFrame:
    """Platform stops paired with the stops less than ``meters`` away, themselves included.

    Stops are put in grid cells and meet only stops of touching cells. A stop
    that is no platform stop itself (``extra_stops``) is paired with itself only.
    """
    platform = F.col("route_id") == PLATFORM_LINE
    wanted = platform | F.col("stop_id").isin(*extra_stops) if extra_stops else platform
    seen = visits.where(wanted).select("stop_id", "route_id", "stop_lat", "stop_lon").distinct()
    stops = (
        seen.groupBy("stop_id")
        .agg(F.min(F.struct((~platform).alias("other"), "route_id", "stop_lat", "stop_lon")).alias("s"))
        .select("stop_id", "s.route_id", "s.stop_lat", "s.stop_lon")
    )
    x, y, z = sphere_cell(F.col("stop_lat"), F.col("stop_lon"), meters)
    at = stops.withColumns({"x": x, "y": y, "z": z})
    steps = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    around = (
        at.withColumn("x", F.explode(F.transform(steps, lambda d: F.col("x") + d)))
        .withColumn("y", F.explode(F.transform(steps, lambda d: F.col("y") + d)))
        .withColumn("z", F.explode(F.transform(steps, lambda d: F.col("z") + d)))
        .select(
            "x", "y", "z",
            F.col("stop_id").alias("stop_id_alternative"),
            F.col("stop_lat").alias("stop_lat_alternative"),
            F.col("stop_lon").alias("stop_lon_alternative"),
        )
    )
    distance = great_circle_meters(
        F.col("stop_lat"), F.col("stop_lon"), F.col("stop_lat_alternative"), F.col("stop_lon_alternative")
    )
    near = at.join(around, ["x", "y", "z"]).where(distance < meters).drop("x", "y", "z")
    # a stop without a position has no neighbour but stays in the table
    paired = stops.join(near.drop("route_id", "stop_lat", "stop_lon"), "stop_id", "left")
    return paired.where((F.col("route_id") == PLATFORM_LINE) | (F.col("stop_id") == F.col("stop_id_alternative")))


def tap_keys(legs: DataFrame, mode: Column) -> DataFrame:
    """The few columns of a leg that candidate search and scoring need."""
    return legs.where(mode).select(
        "card_id",
        "datetime",
        epoch("datetime").alias("tap_s"),
        epoch("datetime_next").alias("next_s"),
        "service_date",
        "line_id",
        "stop_id",
        "stop_lat",
        "stop_lon",
        F.col("stop_lat_next").alias("next_lat"),
        F.col("stop_lon_next").alias("next_lon"),
    )


def use_alternatives(taps: DataFrame, alternatives: DataFrame) -> DataFrame:
    """One row per tap and alternative stop; the tapped stop goes to ``stop_id_old``."""
    pairs = alternatives.select(
        F.col("stop_id").alias("stop_id_old"),
        F.col("stop_id_alternative").alias("stop_id"),
        F.col("stop_lat_alternative").alias("stop_lat"),
        F.col("stop_lon_alternative").alias("stop_lon"),
    )
    return taps.withColumnRenamed("stop_id", "stop_id_old").drop("stop_lat", "stop_lon").join(
        pairs, "stop_id_old", "left"
    )


def _visit_times(visits: DataFrame) -> DataFrame:
    return visits.select(
        F.col("service_date").alias("v_date"),
        F.col("stop_id").alias("v_stop"),
        F.col("route_id").alias("v_line"),
        epoch("arrive_datetime").alias("arrive_s"),
        epoch("departure_datetime").alias("depart_s"),
        *[F.col(old).alias(new) for new, old in _BOARDED.items()],
    )


def slice_seconds(visits: DataFrame, longest: int = SLICE_SECONDS) -> int:
    """Length of the slices for these visits: a few mean gaps between the vehicles of a stop, line and direction.

    With slices of a fixed length the pairs of taps and spans in a slice grow with
    the square of how densely stops are served. The gaps shrink as it rises, so a
    tap always meets about as many spans; and a span, which lasts one gap, is in few
    slices, so that these are at most about half as many again as there are spans.
    Counted at once from the key columns, combined ahead of the shuffle.
    """
    keys = ["service_date", "stop_id", "route_id", "route_id_old", "direction_id"]
    groups = visits.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    seen = groups.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("visits")).first()
    if not seen["visits"]:
        return longest
    return max(1, min(longest, ceil(GAPS_PER_SLICE * DAY_SECONDS * seen["groups"] / seen["visits"])))


def _slices(first: Column, last: Column, width: int) -> Column:
    """Slice numbers of a time span of the service day; nothing for an empty span."""
    low = F.coalesce(service_slice(F.col("v_date"), first, width), F.lit(0))
    top = service_slice(F.col("v_date"), F.lit(2**40), width)
    high = F.coalesce(service_slice(F.col("v_date"), last, width), top)
    return F.when(F.coalesce(first, F.lit(-(2**40))) <= F.coalesce(last, F.lit(2**40)), F.sequence(low, high))


def _attach(taps: DataFrame, spans: DataFrame, width: int) -> DataFrame:
    """Left join of taps to the span ``from_s .. to_s`` that holds the tap, one row per visit in ``near``.

    Taps and spans meet in a slice of the day, ``width`` seconds long, so a busy stop spreads over many
    keys and a tap is tested against the visits around it only. Each tap falls
    in at most one span per key: no pairs of all taps and visits are made.
    """
    tap_slice = service_slice(F.col("service_date"), F.col("tap_s"), width)
    on = (
        (F.col("service_date") == F.col("v_date"))
        & (F.col("stop_id") == F.col("v_stop"))
        & (F.col("line_id") == F.col("v_line"))
        & (F.col("slice") == F.col("v_slice"))
        & (F.col("from_s").isNull() | (F.col("tap_s") >= F.col("from_s")))
        & (F.col("to_s").isNull() | (F.col("tap_s") <= F.col("to_s")))
    )
    return (
        taps.withColumn("slice", tap_slice)
        .join(spans.withColumn("v_slice", F.explode("slices")).drop("slices"), on, "left")
        .drop("slice", "v_slice", "v_date", "v_stop", "v_line", "from_s", "to_s")
    )


def _visit_struct() -> Column:
    return F.struct("arrive_s", "depart_s", *_BOARDED)


def platform_candidates(
    taps: DataFrame, visits: DataFrame, alternatives: DataFrame, width: int = SLICE_SECONDS
) -> DataFrame:
    """The two next departures per route and direction for taps made before boarding.

    Each visit is given the span of tap times for which it is the next
    departure, and carries the departure after it. Visits are dealt by date, stop and line, which
    serves the windows and the join with the taps; a tap's departures go on to the ranking in pairs.
    """
    keys = ["v_date", "v_stop", "v_line", "board_route", "board_direction_id"]
    order = Window.partitionBy(*keys).orderBy("depart_s", "run_id", "board_sequence")
    served = _visit_times(visits.where(F.col("route_id") == PLATFORM_LINE)).where(F.col("depart_s").isNotNull())
    served = served.repartition("v_date", "v_stop", "v_line")
    spans = served.select(
        "v_date", "v_stop", "v_line",
        (F.lag("depart_s").over(order) + 1).alias("from_s"),
        F.col("depart_s").alias("to_s"),
        F.array_compact(F.array(_visit_struct(), F.lead(_visit_struct()).over(order))).alias("near"),
    ).withColumn("slices", _slices(F.col("from_s"), F.col("to_s"), width))
    found = _attach(use_alternatives(taps, alternatives), spans, width).repartition("card_id", "datetime")
    each = found.withColumn("v", F.explode_outer("near")).select("*", "v.*").drop("near", "v")
    # alternatives may serve the same route: two per route and direction in all
    best = Window.partitionBy("card_id", "datetime", "board_route", "board_direction_id").orderBy(
        F.col("depart_s"), F.col("run_id"), F.col("board_sequence"), F.col("stop_id")
    )
    return each.withColumn("__n", F.row_number().over(best)).where(F.col("__n") <= 2).drop("__n")


def score_platform_boarding(candidates: DataFrame) -> DataFrame:
    """Boarding probability, adding up to 1 per tap, route and direction."""
    h = F.col("board_headway")
    chance = (1 - F.exp(F.try_divide(F.lit(-1.0), h))) * F.exp(
        F.try_divide(-(F.col("depart_s") - F.col("tap_s")), h)
    )
    group = Window.partitionBy("card_id", "datetime", "board_route", "board_direction_id")
    return candidates.withColumn("__p", chance).withColumn(
        "boarding_probability", F.try_divide(F.col("__p"), F.sum("__p").over(group))
    ).drop("__p")


def _onboard_found(taps: DataFrame, visits: DataFrame, width: int) -> DataFrame:
    order = Window.partitionBy("v_date", "v_stop", "v_line").orderBy("arrive_s", "run_id", "board_sequence")
    served = _visit_times(visits).where(F.col("arrive_s").isNotNull() & (F.col("v_line") != PLATFORM_LINE))
    # dealt ahead of the window, or the structs it looks at would be shuffled beside their columns
    served = served.repartition("v_date", "v_stop", "v_line")
    spans = served.select(
        "v_date", "v_stop", "v_line",
        F.col("arrive_s").alias("from_s"),
        (F.lead("arrive_s").over(order) - 1).alias("to_s"),
        F.array_compact(
            F.array(_visit_struct(), *[F.lag(_visit_struct(), k).over(order) for k in (1, 2)])
        ).alias("near"),
    ).withColumn("slices", _slices(F.col("from_s"), F.col("to_s"), width))
    return _attach(taps.withColumn("stop_id_old", F.col("stop_id")), spans, width)


def onboard_candidates(taps: DataFrame, visits: DataFrame, width: int = SLICE_SECONDS) -> DataFrame:
    """The three latest arrivals for taps made in the vehicle.

    Each visit has the span of tap times up to the next arrival and carries the
    two arrivals before it, so no ranking after the join is needed.
    """
    found = _onboard_found(taps, visits, width)
    return found.withColumn("v", F.explode_outer("near")).select("*", "v.*").drop("near", "v")


def score_onboard_boarding(candidates: DataFrame) -> DataFrame:
    """Boarding probability, adding up to 1 per tap."""
    group = Window.partitionBy("card_id", "datetime")
    return (
        candidates.withColumn("__p", _onboard_chance(F.col("tap_s"), F.col("arrive_s"), F.col("board_headway")))
        .withColumn("boarding_probability", F.try_divide(F.col("__p"), F.sum("__p").over(group)))
        .drop("__p")
    )


def _onboard_chance(tap: Column, arrive: Column, h: Column) -> Column:
    scale = F.try_divide(1 - F.exp(F.try_divide(F.lit(-1.0), h)), 1 - F.exp(F.try_divide(-(h + 1), h)))
    return scale * F.exp(F.try_divide(-(tap - arrive), h))


def scored_onboard_candidates(taps: DataFrame, visits: DataFrame, width: int = SLICE_SECONDS) -> DataFrame:
    """Candidates and probability together.

    The visits of a tap are still one array when the probabilities are
    normalised, which saves the shuffle that a window per tap costs.
    """
    found = _onboard_found(taps, visits, width)
    chances = F.transform("near", lambda v: _onboard_chance(F.col("tap_s"), v["arrive_s"], v["board_headway"]))
    total = F.aggregate(
        F.filter("__p", lambda p: p.isNotNull()), F.lit(0.0), lambda a, p: a + p
    )
    each = (
        found.withColumn("__p", chances)
        .withColumn("__total", total)
        .withColumn("v", F.explode_outer(F.arrays_zip("near", "__p")))
    )
    return each.select(
        *[c for c in found.columns if c != "near"],
        "v.near.*",
        F.try_divide(F.col("v.__p"), F.col("__total")).alias("boarding_probability"),
    )
