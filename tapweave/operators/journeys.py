"""From legs to journeys and rider events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tapweave.functions.geo import great_circle_meters
from tapweave.functions.stage import noted
from tapweave.functions.windows import over_narrow
from tapweave.operators.rules import reasons
from tapweave.operators.taps import null_counts, require_no_nulls

# --- fixed values ------------------------------------------------------------
LONGEST_WAIT_SECONDS = 7200
ALLOWED_EVENT_PAIRS = (
    "BOARDED-ALIGHTED",
    "BOARDED-INTERLINE_STARTED",
    "INTERLINE_STARTED-INTERLINE_ENDED",
    "INTERLINE_ENDED-INTERLINE_STARTED",
    "INTERLINE_ENDED-ALIGHTED",
    "ALIGHTED-BOARDED",
    "ALIGHTED-NONE",
)
# -----------------------------------------------------------------------------

EVENT_COLUMNS = (
    "fare_category_description",
    "datetime",
    "stop_id",
    "card_id",
    "journey_id",
    "line_id",
    "stop_lat",
    "stop_lon",
    "direction_id",
    "validity_score",
    "event",
    "confidence",
)


def attach_choices(legs: DataFrame, chosen: DataFrame) -> DataFrame:
    """Every leg with the ride chosen for it; legs that no ride was looked for stay, without one.

    A tap without a readable time or line has no candidates. Its own columns
    are kept, and the rules then give the reasons. Card and time are those of the leg, so
    the rows still lie by card for the windows that follow.
    """
    ride = chosen.withColumnsRenamed({c: f"__{c}" for c in chosen.columns})
    on = (F.col("card_id") == F.col("__card_id")) & (F.col("datetime") == F.col("__datetime"))
    both = legs.join(ride, on, "left")
    taken = {c: F.col(f"__{c}") for c in chosen.columns if c not in legs.columns}
    found = F.col("__card_id").isNotNull()
    shared = {c: F.when(found, F.col(f"__{c}")).otherwise(F.col(c)) for c in chosen.columns if c in legs.columns and c not in ("card_id", "datetime")}
    return both.withColumns(taken | shared).select(*dict.fromkeys([*legs.columns, *chosen.columns]))


def _card() -> "Window":
    return Window.partitionBy("card_id").orderBy("datetime")


# What the ids of journeys are made from.
_BUILT_FROM = ("card_id", "datetime", "board_headway", "next_s", "alight_s", "transfer_seconds")


def build_journeys(legs: DataFrame, wait_minutes: int, narrow: bool = False) -> DataFrame:
    """Journey ids: a run of legs up to one after which the rider stayed.

    The rider stayed when the wait for the next vehicle was long for its
    headway, longer than two hours, or unknown. The limit falls from 3 to 1
    headways along a sigmoid around ``wait_minutes``. ``narrow`` is for legs whose
    columns all go on, see ``over_narrow``; so it is below.
    """
    if narrow:
        return over_narrow(legs, _BUILT_FROM, lambda few: build_journeys(few, wait_minutes))
    timed = legs.withColumns(
        {
            "next_headway": F.lead("board_headway").over(_card()),
            "wait_seconds": F.col("next_s") - F.col("alight_s") - F.col("transfer_seconds"),
        }
    )
    wait, headway = F.col("wait_seconds"), F.col("next_headway")
    limit = 3 - 2 / (1 + F.sqrt(F.exp(-(headway - wait_minutes))))
    stayed = (
        wait.isNull()
        | headway.isNull()
        | (wait > LONGEST_WAIT_SECONDS)
        | (F.try_divide(wait, headway) > limit)
    )
    ended = timed.withColumn("is_journey_end", F.coalesce(stayed, F.lit(False)))
    starts = F.coalesce(F.lag("is_journey_end").over(_card()), F.lit(True))
    start_id = F.sha2(F.concat(F.col("card_id").cast("string"), F.col("datetime").cast("string")), 256)
    upto = _card().rowsBetween(Window.unboundedPreceding, 0)
    return (
        ended.withColumn("__start", F.when(starts, start_id))
        .withColumn("journey_id", F.last("__start", ignorenulls=True).over(upto))
        .drop("__start")
    )


def judge_journeys(legs: DataFrame, max_days: int, narrow: bool = False) -> DataFrame:
    """Add the reasons against each leg and whether the whole journey falls."""
    judged = legs.withColumn("reasons_for_impossibility", reasons(max_days))
    # in order of time, so that the validity scores, whose windows follow, need no sort of their own
    journey = Window.partitionBy("card_id", "journey_id").orderBy("datetime")
    against = F.sum(F.size("reasons_for_impossibility")).over(
        journey.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )

    def tagged(few: DataFrame) -> DataFrame:
        return few.withColumn("is_impossible", against > 0)

    keep = ("card_id", "journey_id", "datetime", "reasons_for_impossibility")
    return over_narrow(judged, keep, tagged) if narrow else tagged(judged)


def split_journeys(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Possible legs and impossible legs; one bad leg takes its whole journey along."""
    bad = F.col("is_impossible")
    possible = judged.where(~bad).drop("is_impossible", "reasons_for_impossibility")
    return possible, judged.where(bad).drop("is_impossible")


# What ``add_validity_score`` adds.
SCORE_COLUMNS = ("origin_origin_meters", "max_transfer_meters", "validity_score")


def add_validity_score(legs: DataFrame, whole_journey: bool = False, narrow: bool = False) -> DataFrame:
    """``1 / (1 + longest transfer / distance to the next origin)``, 0 without distance.

    By default the score of a leg looks at the journey up to that leg and takes
    the leg's own next tap as next origin, as the original method does.
    ``whole_journey`` scores origin against the tap after the last leg instead.
    """
    order = Window.partitionBy("card_id", "journey_id").orderBy("datetime")
    if whole_journey:
        frame = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        here = [F.first(c).over(frame) for c in ("stop_lat", "stop_lon")]
        there = [F.last(c).over(frame) for c in ("stop_lat_next", "stop_lon_next")]
    else:
        frame = order.rowsBetween(Window.unboundedPreceding, 0)
        here, there = [F.col("stop_lat"), F.col("stop_lon")], [F.col("stop_lat_next"), F.col("stop_lon_next")]

    def measured(few: DataFrame) -> DataFrame:
        return few.withColumns(
            {
                "origin_origin_meters": great_circle_meters(*here, *there),
                "max_transfer_meters": F.max("transfer_meters").over(frame),
            }
        )

    places = ("stop_lat", "stop_lon", "stop_lat_next", "stop_lon_next")
    keep = ("card_id", "journey_id", "datetime", "transfer_meters", *places)
    scored = over_narrow(legs, keep, measured) if narrow else measured(legs)
    ratio = F.try_divide(F.col("max_transfer_meters"), F.col("origin_origin_meters"))
    score = F.when(F.col("origin_origin_meters") == 0, F.lit(0.0)).otherwise(1 / (1 + ratio))
    return scored.withColumn("validity_score", score)


def _at(second: str) -> Column:
    return F.timestamp_seconds(F.col(second))


def _event(name: str, time: Column, place: Sequence[str], line: str, confidence: Column) -> Column:
    stop, lat, lon = place
    return F.struct(
        time.alias("datetime"),
        F.col(stop).alias("stop_id"),
        F.col(line).alias("line_id"),
        F.col(lat).alias("stop_lat"),
        F.col(lon).alias("stop_lon"),
        F.lit(name).alias("event"),
        confidence.cast("double").alias("confidence"),
    )


_BOARD_PLACE = ("stop_id", "stop_lat", "stop_lon")
_ALIGHT_PLACE = ("alight_stop_id", "alight_lat", "alight_lon")
_INTERLINE_PLACE = ("interline_stop_id", "interline_stop_lat", "interline_stop_lon")


def journey_events(legs: DataFrame, interlines: DataFrame) -> DataFrame:
    """Rider events of possible legs: boarded, alighted, interline started and ended."""
    kept = [
        "fare_category_description",
        "card_id",
        "journey_id",
        F.col("board_direction_id").alias("direction_id"),
        "validity_score",
    ]
    got_off = F.col("next_s").isNotNull() & F.col("alight_stop_id").isNotNull()
    rides = F.array_compact(
        F.array(
            _event("BOARDED", _at("arrive_s"), _BOARD_PLACE, "board_route", F.lit(1)),
            F.when(
                got_off, _event("ALIGHTED", _at("alight_s"), _ALIGHT_PLACE, "alight_route", F.col("confidence"))
            ),
        )
    )
    passed = interlines.where(
        F.col("interline_stop_id").isNotNull()
        & F.col("interline_stop_lat").isNotNull()
        & F.col("next_s").isNotNull()
        & (F.col("interline_arrive") > _at("arrive_s"))
        & (F.col("interline_departure") < _at("alight_s"))
    )
    changes = F.array(
        _event("INTERLINE_STARTED", F.col("interline_arrive"), _INTERLINE_PLACE, "board_route", F.col("confidence")),
        _event("INTERLINE_ENDED", F.col("interline_departure"), _INTERLINE_PLACE, "alight_route", F.col("confidence")),
    )
    events = legs.select(*kept, F.inline(rides)).unionByName(passed.select(*kept, F.inline(changes)))
    return events.select(*EVENT_COLUMNS)


def failed_events(legs: DataFrame) -> DataFrame:
    """Impossible legs as events at tap time, with the reasons."""
    rides = F.array_compact(
        F.array(
            _event("BOARDED", F.col("datetime"), _BOARD_PLACE, "board_route", F.lit(1)),
            F.when(
                F.col("stop_id_next").isNotNull(),
                _event("ALIGHTED", _at("alight_s"), _ALIGHT_PLACE, "alight_route", F.col("confidence")),
            ),
        )
    )
    kept = ["card_id", "journey_id", "direction_id", "service_date", "reasons_for_impossibility"]
    return legs.select(*kept, F.inline(rides))


# Rider events of one journey in order. Events at the same second come as:
# getting off, boarding, interline start, interline end.
_SAME_SECOND = ("ALIGHTED", "BOARDED", "INTERLINE_STARTED", "INTERLINE_ENDED")


def event_order() -> list[Column]:
    rank = F.array_position(
        F.array(*[F.lit(e) for e in _SAME_SECOND]), F.col("event")
    )
    return [F.col("datetime"), rank, F.col("stop_id"), F.col("line_id")]


JOURNEY_KEYS = ("card_id", "journey_id")


def _journey():
    return Window.partitionBy(*JOURNEY_KEYS).orderBy(*event_order())


def _whole():
    return _journey().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def add_event_type(events: DataFrame) -> DataFrame:
    """ORIGIN, DESTINATION or MID_JOURNEY; interline events do not count as first or last."""
    counts = F.when(~F.col("event").contains("INTERLINE"), 1).otherwise(0)
    numbered = events.withColumns(
        {
            "__n": F.sum(counts).over(_journey().rowsBetween(Window.unboundedPreceding, 0)),
            "__of": F.sum(counts).over(_whole()),
        }
    )
    kind = (
        F.when((F.col("event") == "BOARDED") & (F.col("__n") == 1), "ORIGIN")
        .when((F.col("event") == "ALIGHTED") & (F.col("__n") == F.col("__of")), "DESTINATION")
        .otherwise("MID_JOURNEY")
    )
    return numbered.withColumn("event_type", kind).drop("__n", "__of")


def tag_loops(events: DataFrame, meters: float) -> DataFrame:
    """``is_loop``: the journey ends less than ``meters`` from where it began."""
    ends = [f(c).over(_whole()) for f in (F.last, F.first) for c in ("stop_lat", "stop_lon")]
    near = great_circle_meters(*ends) < meters
    return events.withColumn("is_loop", F.coalesce(near, F.lit(False)))


def drop_without_destination(events: DataFrame) -> DataFrame:
    journey = Window.partitionBy(*JOURNEY_KEYS)
    arrives = F.bool_or(F.col("event_type") == "DESTINATION").over(journey)
    return events.withColumn("__arrives", arrives).where("__arrives").drop("__arrives")


def drop_odd_sequences(events: DataFrame) -> DataFrame:
    """Drop journeys in which an event is followed by one that cannot follow it."""
    following = F.coalesce(F.lead("event").over(_journey()), F.lit("NONE"))
    paired = events.withColumn("__ok", F.concat_ws("-", "event", following).isin(*ALLOWED_EVENT_PAIRS))
    journey = Window.partitionBy(*JOURNEY_KEYS)
    return paired.withColumn("__all", F.bool_and("__ok").over(journey)).where("__all").drop("__ok", "__all")


def add_start_date(events: DataFrame) -> DataFrame:
    journey = Window.partitionBy(*JOURNEY_KEYS)
    return events.withColumn("journey_start_date", F.to_date(F.min("datetime").over(journey)))


def null_report(events: DataFrame) -> DataFrame:
    """Number of nulls per column of the rider events."""
    return null_counts(events, events.columns)


def require_complete(events: DataFrame) -> DataFrame:
    return require_no_nulls(events, events.columns)


def watch_complete(events: DataFrame, watch: Observation) -> DataFrame:
    """The events, whose nulls per column ``watch`` counts while somebody writes them."""
    return events.observe(watch, *[F.count_if(F.col(c).isNull()).alias(c) for c in events.columns])


def require_watched(watch: Observation) -> None:
    """The error of ``require_complete``; call it after the write."""
    bad = [column for column, nulls in noted(watch).items() if nulls]
    if bad:
        raise ValueError(f"nulls found in {', '.join(bad)}")
