"""Comparison of two runs by their single-leg trips."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapweave.config import FEET_PER_METER, PLATFORM_REPORT_LINES
from tapweave.functions.geo import great_circle_meters
from tapweave.functions.quantiles import quantile_columns
from tapweave.functions.windows import left_lookup
from tapweave.operators.journeys import event_order

STEPS = tuple(p / 100 for p in range(0, 120, 20))


def look_ahead(events: DataFrame, following: DataFrame) -> DataFrame:
    """Events with the next two events of the card and the distances to them.

    ``following`` is the table of ``profiles.next_stops``; lines that go on to
    different stops by direction count with the lowest direction.
    """
    onward = following.groupBy("line_id", "stop_id").agg(
        F.min(F.struct("direction_id", "trip_stop_id_next"))["trip_stop_id_next"].alias("trip_stop_id_next")
    )
    card = Window.partitionBy("card_id").orderBy(*event_order())
    same = Window.partitionBy("card_id", "journey_id", "datetime", "event").orderBy("stop_id", "line_id")
    # both windows run on this shuffle
    once = events.repartition("card_id").withColumn("__n", F.row_number().over(same)).where("__n = 1").drop("__n")
    seen = F.struct("stop_id", "stop_lat", "stop_lon", "datetime", "event", "event_type", "confidence")
    ahead = once.withColumns({"one": F.lead(seen, 1).over(card), "two": F.lead(seen, 2).over(card)})

    def meters(a: str, b: str):
        return great_circle_meters(*[F.col(x + c) for x in (a, b) for c in ("stop_lat", "stop_lon")])

    wide = ahead.withColumns(
        {
            "distance_to_next_stop": meters("", "one."),
            "distance_to_next_next_stop": meters("", "two."),
            "alighting_distance_to_next_stop": meters("one.", "two."),
            "stop_id_next": F.col("one.stop_id"),
            "confidence_next": F.col("one.confidence"),
            "stop_id_next_next": F.col("two.stop_id"),
            "event_next_next": F.col("two.event"),
            "event_type_next_next": F.col("two.event_type"),
            "days_to_next_origin": F.date_diff("two.datetime", "datetime"),
        }
    ).drop("one", "two")
    return wide.join(onward, ["line_id", "stop_id"], "left")


def on_platform(df: DataFrame, lines: Sequence[int] = PLATFORM_REPORT_LINES) -> DataFrame:
    return df.withColumn("is_platform", F.when(F.col("line_id").isin(*lines), "Y").otherwise("N"))


def single_leg_trips(ahead: DataFrame) -> DataFrame:
    """Origins whose second next event is an origin again, with three flags."""

    def yes(condition):
        return F.when(condition, "Y").otherwise("N")

    lone = (F.col("event_type") == "ORIGIN") & (F.col("event_type_next_next") == "ORIGIN")
    return ahead.where(lone).withColumns(
        {
            "is_null_journey": yes(F.col("stop_id") == F.col("stop_id_next_next")),
            "is_single_stop_ride": yes(F.col("stop_id_next") == F.col("trip_stop_id_next")),
            "alight_at_next_start_location": yes(F.col("stop_id_next") == F.col("stop_id_next_next")),
        }
    )


def single_leg_summary(trips: DataFrame) -> DataFrame:
    """Count, share and distance quantiles by the flags: whole meters, turned to feet.

    The share comes from a window over the few grouped rows.
    """
    by = ["is_single_stop_ride", "alight_at_next_start_location"]
    quantiles = quantile_columns(trips, by, "alighting_distance_to_next_stop", STEPS, "percentile_distance")
    grouped = left_lookup(trips.groupBy(*by).agg(F.count(F.lit(1)).alias("n_journeys")), by, quantiles)
    feet = {
        c: F.col(c).cast("int") * FEET_PER_METER for c in grouped.columns if c.startswith("percentile_distance")
    }
    total = F.sum("n_journeys").over(Window.partitionBy())
    return grouped.withColumns(feet).withColumn(
        "percent_journeys", (100 * F.col("n_journeys") / total).cast("float")
    )


def line_shares(trips: DataFrame) -> DataFrame:
    """Single-stop rides by line: count, mean confidence, share; shares up to 0.01 % left out."""
    grouped = trips.where(F.col("is_single_stop_ride") == "Y").groupBy("line_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("confidence_next").alias("mean_confidence")
    )
    total = F.sum("n").over(Window.partitionBy())
    return grouped.withColumn("percentage", F.col("n") / total * 100).where(F.col("percentage") > 0.01)


def compare_line_shares(control: DataFrame, fixed: DataFrame) -> DataFrame:
    """Full outer merge of ``line_shares`` of two runs."""
    sides = []
    for name, shares in (("control", control), ("fixed", fixed)):
        sides.append(shares.withColumnsRenamed({c: f"{c}_{name}" for c in shares.columns if c != "line_id"}))
    return sides[0].join(sides[1], "line_id", "full_outer")


def compare_runs(control: DataFrame, fixed: DataFrame, lines: Sequence[int] = PLATFORM_REPORT_LINES) -> DataFrame:
    """Line shares of two runs' single-leg trips, as a full merge: platform lines only, the fixed run
    limited to cards of the control run's trips."""
    before = control.where(F.col("line_id").isin(*lines))
    after = fixed.where(F.col("line_id").isin(*lines)).join(before.select("card_id").distinct(), "card_id", "left_semi")
    return compare_line_shares(line_shares(before), line_shares(after))


def compare_by_platform_lines(control: DataFrame, fixed: DataFrame, following: DataFrame) -> DataFrame:
    """Confidence quantiles by number of platform lines of two runs, for numbers that both have."""
    sides = []
    for name, trips in (("control", control), ("fixed", fixed)):
        figures = confidence_by_platform_lines(trips, following)
        sides.append(figures.withColumnsRenamed({c: f"{c}_{name}" for c in figures.columns if c != "n_platform_lines"}))
    return sides[0].join(sides[1], "n_platform_lines")


def of_cards_in(events: DataFrame, control: DataFrame) -> DataFrame:
    """Events of the control run's cards; a card without events has one row of nulls."""
    return events.join(control.select("card_id").distinct(), "card_id", "right")


def confidence_spread(trips: DataFrame) -> DataFrame:
    """Mean and deviation of confidence and distance by single-stop flag and mode."""
    return trips.groupBy("is_single_stop_ride", "is_platform").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("confidence_next").alias("confidence_mean"),
        F.stddev_samp("confidence_next").alias("confidence_std"),
        F.avg("alighting_distance_to_next_stop").alias("distance_mean"),
        F.stddev_samp("alighting_distance_to_next_stop").alias("distance_std"),
    )


def confidence_quantiles(trips: DataFrame, by: str) -> DataFrame:
    quantiles = quantile_columns(trips, [by], "confidence_next", STEPS, "percentile")
    return left_lookup(trips.groupBy(by).agg(F.count(F.lit(1)).alias("n")), [by], quantiles)


def platform_lines_per_stop(following: DataFrame, lines: Sequence[int] = PLATFORM_REPORT_LINES) -> DataFrame:
    return following.where(F.col("line_id").isin(*lines)).groupBy("stop_id").agg(
        F.count_distinct("line_id").alias("n_platform_lines")
    )


def confidence_by_platform_lines(trips: DataFrame, following: DataFrame) -> DataFrame:
    joined = trips.join(platform_lines_per_stop(following), "stop_id")
    return confidence_quantiles(joined, "n_platform_lines")


def duplicate_events(events: DataFrame) -> DataFrame:
    """Card, time and journey with more than one ride event."""
    rides = events.where(F.col("event").isin("BOARDED", "ALIGHTED"))
    return rides.groupBy("card_id", "datetime", "journey_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def run_checks(trips: DataFrame, events: DataFrame) -> DataFrame:
    """Single-leg journeys, duplicate events, and single-leg trips that stay at their stop."""
    journeys = trips.agg(F.count_distinct("journey_id").alias("n")).select(F.lit("single_leg_journeys").alias("check"), "n")
    repeated = duplicate_events(events).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("duplicate_events").alias("check"), "n"
    )
    still = trips.agg(F.count_if(F.col("stop_id") == F.col("stop_id_next")).alias("n")).select(
        F.lit("same_stop_trips").alias("check"), "n"
    )
    return journeys.unionByName(repeated).unionByName(still)


def checks_of_runs(
    runs: Mapping[str, tuple[DataFrame, DataFrame]], lines: Sequence[int] = PLATFORM_REPORT_LINES
) -> DataFrame:
    """``run_checks`` of several runs (single-leg trips and events by name), platform lines only, with ``run``."""
    out = None
    for name, (trips, events) in runs.items():
        on_lines = F.col("line_id").isin(*lines)
        told = run_checks(trips.where(on_lines), events.where(on_lines)).select(F.lit(name).alias("run"), "check", "n")
        out = told if out is None else out.unionByName(told)
    return out
