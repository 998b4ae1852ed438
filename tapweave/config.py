"""Run settings.

All fields are plain values, so a run is described by one ``Settings`` object.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values (parity data; the results depend on them) -----------------
PLATFORM_LINE = 200
LINE_ALIASES = {290: 200, 90: 200, 100: 200, 190: 200, 203: 200, 194: 193, 195: 193, 196: 193}
PLATFORM_REPORT_LINES = (200, 100, 90, 190, 290)
UNWANTED_OPERATORS = ("CTRAN", "PSC", "WES")
EXTRA_PLATFORM_STOPS = (7999,)
REQUIRED_TAP_COLUMNS = ("CARD_ID", "TAP_TIME", "LINE_ID", "STOP_ID")
VISIT_SOURCE = "AVL_STOP_EVENTS"
STOPS_OF_INTEREST = (8376, 8341, 8342, 8375, 8373, 8344, 8372, 8345, 8371, 8346)
FEET_PER_METER = 3.3
FEET_PER_MILE = 5280
LEG_COLUMNS = (
    "datetime",
    "service_date",
    "line_id",
    "stop_id",
    "stop_lat",
    "stop_lon",
    "direction_id",
    "geolocationlatitude",
    "geolocationlongitude",
    "transaction_ticket_description",
    "fare_category_description",
    "is_unwanted_operator",
)
# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Knobs of a prepare or infer run; the defaults are the production values."""

    burst_seconds: int = 20
    line_aliases: dict[int, int] = field(default_factory=lambda: dict(LINE_ALIASES))
    unwanted_operators: tuple[str, ...] = UNWANTED_OPERATORS
    required_tap_columns: tuple[str, ...] = REQUIRED_TAP_COLUMNS
    extra_platform_stops: tuple[int, ...] = EXTRA_PLATFORM_STOPS
    leg_columns: tuple[str, ...] = LEG_COLUMNS
    year_months: tuple[tuple[int, int], ...] | int = -1
    alternative_meters: float = 153
    loop_meters: float = 61
    walking_speed: float = 1.5
    wait_minutes: int = 15
    max_days_to_destination: int = 7
    allow_interlining: bool = True
    allow_no_stops: bool = False
    keep_first_stop: bool = False
    # trips of a day without a block count as one block, as in the original method
    null_blocks: bool = True
    # scale: length of the slices that cards are cut into
    slice_seconds: int = 900
    # scale: groups of visits or trips with more rows are cut into slices
    window_rows: int = 1_000_000
    # scale: a run has one task for every so many pairs of its boardings and stops
    task_pairs: int = 1_000_000
    # write the tables used several times (see functions/stage.py)
    staged: bool = True

    def but(self, **changes) -> "Settings":
        return replace(self, **changes)


# Spark settings the plans are written for; all can be set on a live session.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a join on (card, time) may reuse data already partitioned by card alone
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # the default has 12 bytes of which an encoding can save nothing
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def tune(spark):
    """Apply ``SESSION_CONF`` to a session and return it."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark
