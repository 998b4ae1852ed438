"""What makes a leg impossible."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapweave.functions.geo import great_circle_meters

# --- fixed values: the reason texts of the output ---------------------------
SAME_AS_NEXT_TIME = "ALIGHTING DATETIME EQUAL TO NEXT BOARDING DATETIME"
SAME_STOP = "NEXT STOP ID IS SAME AS CURRENT"
WALK_TOO_LONG = "ALIGHTING TIME PLUS TRANSFER TIME IS AFTER NEXT BOARDING TIME"
TIME_ORDER = "ALIGHTING TIME IS BEFORE BOARDING TIME"
NO_TRIP = "FAILED TO FIND BOARDING TRIP ID"
NO_PLACE = "STOP_LAT OR STOP_LON ARE NULL"
NO_LINE = "LINE ID IS NULL"
NO_WAIT = "COULD NOT CALCULATE INFERRED WAIT TIME"
NO_DISTANCE = "COULD NOT CALCULATE TRANSFER DISTANCE"
NO_CONFIDENCE = "COULD NOT CALCULATE CONFIDENCE SCORE"
NO_BOARDING = "COULD NOT CALCULATE BOARDING PROBABILITY"
NO_ALIGHTING = "COULD NOT CALCULATE ALIGHTING PROBABILITY"
UNWANTED = "OPERATOR IS UNWANTED"
BOARDING_UNPLACED = "BOARDING STOP HAS NO LOCATION"
NO_NEXT_TAP = "NO DESTINATION BOARDING TAP"
NEXT_TAP_FAR = "DESTINATION BOARDING TAP IS MORE THAN {days} DAYS IN THE FUTURE"
NO_NEXT_HEADWAY = "NO BOARDING INTERVAL AT DESTINATION BOARDING TAP"
NO_HEADWAY = "NO BOARDING INTERVAL BOARDING TAP"
NO_OLD_LINE = "OLD LINE ID IS NULL"
TOO_FAST = "VEHICLE ACCOMPLISHED RIDE FASTER THAN 75 MPH"
# and the limits they stand for
SLACK_SECONDS = 300
FASTEST_METERS_PER_SECOND = 30
# ----------------------------------------------------------------------------


def _missing(name: str) -> Column:
    return F.col(name).isNull() | F.isnan(F.col(name))


def impossible_rules(max_days: int) -> list[tuple[str, Column]]:
    """Pairs of reason and condition over a leg with its journey columns.

    A condition that is null does not hold.
    """
    c = F.col
    boarded = c("run_id").isNotNull()
    continued = c("next_s").isNotNull()
    ride_meters = great_circle_meters(c("stop_lat"), c("stop_lon"), c("alight_lat"), c("alight_lon"))
    return [
        (SAME_AS_NEXT_TIME, c("alight_s") == c("next_s")),
        (SAME_STOP, c("stop_id") == c("stop_id_next")),
        (WALK_TOO_LONG, c("alight_s") + c("transfer_seconds") > c("next_s") + SLACK_SECONDS),
        (TIME_ORDER, (c("alight_s") <= c("tap_s")) | (c("alight_s") > c("next_s"))),
        (NO_TRIP, (c("is_unwanted_operator") & ~boarded) | c("stop_id").isNull()),
        (NO_PLACE, c("stop_lat").isNull() | c("stop_lon").isNull()),
        (NO_LINE, c("line_id").isNull()),
        (NO_WAIT, boarded & continued & c("wait_seconds").isNull()),
        (NO_DISTANCE, boarded & c("transfer_meters").isNull()),
        (NO_CONFIDENCE, boarded & _missing("confidence")),
        (NO_BOARDING, boarded & c("boarding_probability").isNull()),
        (NO_ALIGHTING, c("alight_stop_id").isNotNull() & _missing("alighting_probability")),
        (UNWANTED, c("is_unwanted_operator")),
        (BOARDING_UNPLACED, boarded & c("stop_lat").isNull()),
        (NO_NEXT_TAP, ~continued),
        (NEXT_TAP_FAR.format(days=max_days), c("next_s") - c("tap_s") > max_days * 86_400),
        (NO_NEXT_HEADWAY, continued & c("next_headway").isNull()),
        (NO_HEADWAY, boarded & c("board_headway").isNull()),
        (NO_OLD_LINE, c("board_route").isNull()),
        (TOO_FAST, F.try_divide(ride_meters, c("alight_s") - c("arrive_s")) > FASTEST_METERS_PER_SECOND),
    ]


def reasons(max_days: int) -> Column:
    """The texts of all rules that hold, each once."""
    held = F.array(*[F.when(condition, F.lit(text)) for text, condition in impossible_rules(max_days)])
    return F.array_distinct(F.array_compact(held))
