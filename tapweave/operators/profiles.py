"""Figures per journey, and what score cut-offs do to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapweave.config import FEET_PER_METER, FEET_PER_MILE, PLATFORM_REPORT_LINES
from tapweave.functions.clock import epoch
from tapweave.functions.geo import great_circle_meters
from tapweave.functions.quantiles import exact_quantiles
from tapweave.functions.stage import stage
from tapweave.operators.journeys import event_order

RIDE_EVENTS = ("BOARDED", "ALIGHTED")


def next_stops(visits: DataFrame) -> DataFrame:
    """The stop that follows on a line: one row per line, stop and direction.

    A trip is taken as it ran on its first date; among trips that go on to
    different stops the smallest trip id decides. The visits are dealt by trip, which serves
    the first date, whose rows are then in the order of the window, and the window.
    """
    needed = ("trip_id", "stop_sequence", "service_date", "arrive_datetime", "stop_id", "route_id_old", "direction_id")
    first = visits.select(*needed).repartition("trip_id").groupBy("trip_id", "stop_sequence").agg(
        F.min(
            F.struct("service_date", "arrive_datetime", "stop_id", F.col("route_id_old").alias("line_id"), "direction_id")
        ).alias("v")
    ).select("trip_id", "stop_sequence", "v.stop_id", "v.line_id", "v.direction_id")
    order = Window.partitionBy("trip_id").orderBy("stop_sequence")
    onward = first.withColumn("following", F.lead("stop_id").over(order))
    return onward.groupBy("line_id", "stop_id", "direction_id").agg(
        F.min(F.struct("trip_id", "stop_sequence", "following"))["following"].alias("trip_stop_id_next")
    )


def _leads(events: DataFrame) -> DataFrame:
    """Following events, per journey and per card, as struct columns.

    The events are dealt by the card first, so all windows and the aggregation
    that follows run on one shuffle; left to itself, Spark deals by the keys of the
    first window and shuffles again for those without the journey.
    """
    events = events.repartition("card_id")
    ride = F.col("event").isin(*RIDE_EVENTS)
    place = F.struct("stop_lat", "stop_lon", "datetime")
    events = events.withColumns(
        {
            "__ride": ride,
            "__ends": F.col("event_type").isin("ORIGIN", "DESTINATION"),
            "__origin": F.col("event_type") == "ORIGIN",
            "__boards": F.col("event") == "BOARDED",
        }
    )

    def along(*extra: str):
        return Window.partitionBy("card_id", *extra).orderBy(*event_order())

    return events.withColumns(
        {
            "__after": F.lead(F.struct("stop_id", "event_type")).over(along("journey_id")),
            "__next_ride": F.lead(place).over(along("journey_id", "__ride")),
            "__next_end": F.lead(place).over(along("journey_id", "__ends")),
            "__next_origin": F.lead(place).over(along("__origin")),
            "__next_boarding": F.lead(place).over(along("__boards")),
        }
    )


def _distance_to(following: str) -> Column:
    there = F.col(following)
    return great_circle_meters(F.col("stop_lat"), F.col("stop_lon"), there["stop_lat"], there["stop_lon"])


def journey_figures(events: DataFrame, platform_lines: Sequence[int] = PLATFORM_REPORT_LINES) -> DataFrame:
    """One row per journey with all its figures, from one shuffle by card."""
    boarded, alighted = F.col("event") == "BOARDED", F.col("event") == "ALIGHTED"
    origin, destination = F.col("event_type") == "ORIGIN", F.col("event_type") == "DESTINATION"
    ride = _distance_to("__next_ride")
    gap = epoch(F.col("__next_boarding.datetime")) - epoch("datetime")
    wait = {
        "alighting_to_next_boarding_distance_meters_max": F.max(F.when(alighted, ride)),
        "alighting_to_next_boarding_distance_meters_min": F.min(F.when(alighted, ride)),
    }
    legs = {
        "n_legs": F.count_if(boarded),
        "leg_distance_meters_min": F.min(F.when(boarded, ride)),
        "leg_distance_meters_max": F.max(F.when(boarded, ride)),
        "total_journey_distance_traveled_meters": F.sum(F.when(boarded, ride)),
    }
    ends = {
        "origin_destination_distance_meters": F.max(F.when(origin, _distance_to("__next_end"))),
        "origin_origin_distance_meters": F.max(F.when(origin, _distance_to("__next_origin"))),
        "max_inter_boarding_time_seconds": F.max(F.when(boarded, gap)),
        "journey_time_seconds": F.max(F.when(destination, epoch("datetime")))
        - F.min(F.when(origin, epoch("datetime"))),
    }
    scores = {
        f"confidence_{name}": f(F.when(alighted, F.col("confidence")))
        for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg))
    }
    lone = origin & (F.col("__after.event_type") == "DESTINATION")
    helper = {
        "__lone": F.max(F.when(lone, F.struct("line_id", "stop_id", "direction_id", F.col("__after.stop_id").alias("off")))),
        "line_ids_used": F.sort_array(F.collect_set("line_id")),
        "validity_scores": F.sort_array(F.collect_set("validity_score")),
    }
    figures = _leads(events).groupBy("card_id", "journey_id").agg(
        *[c.alias(n) for n, c in {**wait, **legs, **ends, **scores, **helper}.items()]
    )
    report = F.array(*[F.lit(i) for i in platform_lines])
    return figures.withColumns(
        {
            "includes_platform": F.arrays_overlap("line_ids_used", report),
            "is_platform_only": F.size(F.array_except("line_ids_used", report)) == 0,
        }
    )


def journey_profiles(
    events: DataFrame,
    visits: DataFrame,
    platform_lines: Sequence[int] = PLATFORM_REPORT_LINES,
    one_row_per_journey: bool = False,
    following: DataFrame | None = None,
) -> DataFrame:
    """The profile table.

    A journey whose legs differ in validity score has one row per score, as in
    the original table; ``one_row_per_journey`` keeps its first score only.
    ``following`` is the table of ``next_stops`` where it is written already; else it is
    written here, so that its size tells Spark whether to broadcast it.
    """
    figures = journey_figures(events, platform_lines)
    following = stage(next_stops(visits), "following") if following is None else following
    follow = following.withColumnsRenamed(
        {"line_id": "f_line", "stop_id": "f_stop", "direction_id": "f_direction"}
    )
    # journeys without a lone leg match nothing; a made-up line each keeps them from meeting under null
    stray = -1 - F.pmod(F.xxhash64("journey_id"), F.lit(2**31))
    line, stop, direction = (F.col(f"__lone.{c}") for c in ("line_id", "stop_id", "direction_id"))
    is_lone = line.isNotNull() & stop.isNotNull() & direction.isNotNull()
    figures = figures.withColumns(
        {
            "__is_lone": is_lone,
            "__line": F.when(is_lone, line.cast("long")).otherwise(stray),
            "__stop": F.when(is_lone, stop).otherwise(F.lit(0)),
            "__direction": F.when(is_lone, direction).otherwise(F.lit(0)),
        }
    )
    on = (
        F.col("__is_lone")
        & (F.col("__line") == F.col("f_line").cast("long"))
        & (F.col("__stop") == F.col("f_stop"))
        & (F.col("__direction") == F.col("f_direction"))
    )
    single = F.coalesce(F.col("__lone.off") == F.col("trip_stop_id_next"), F.lit(False))
    profiled = figures.join(follow, on, "left").withColumn("is_single_stop_ride", single)
    profiled = profiled.drop("__lone", "__is_lone", "__line", "__stop", "__direction", "f_line", "f_stop", "f_direction", "trip_stop_id_next")
    if one_row_per_journey:
        return profiled.withColumn("validity_score", F.get("validity_scores", F.lit(0))).drop("validity_scores")
    return profiled.withColumn("validity_score", F.explode_outer("validity_scores")).drop("validity_scores")


def travel_mode() -> Column:
    """Stratum of a profile row."""
    return (
        F.when(F.col("is_platform_only"), "platform_only")
        .when(F.col("includes_platform"), "mixed")
        .otherwise("onboard_only")
    )


def sample_cards(rows: DataFrame, n: int, key: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows in the order of a seeded hash of ``key``: random, and the same each time."""
    shuffled = F.sha2(F.concat_ws("|", F.lit(str(seed)), *key), 256)
    return rows.withColumn("__h", shuffled).orderBy("__h", *key).limit(n).drop("__h")


def stratified_samples(profiles: DataFrame, events: DataFrame, n: int = 25, seed: int = 0) -> DataFrame:
    """All events of the cards of ``n`` sampled journeys per stratum, with ``stratum``.

    The sample is at most ``3 n`` rows, which bounds the broadcast.
    """
    usable = profiles.where(F.col("origin_origin_distance_meters").isNotNull()).select(
        "card_id", "journey_id", "validity_score", travel_mode().alias("stratum")
    )
    picks = None
    for stratum in ("platform_only", "onboard_only", "mixed"):
        key = ["journey_id", "validity_score"]
        pick = sample_cards(usable.where(F.col("stratum") == stratum), n, key, seed).select("card_id", "stratum")
        picks = pick if picks is None else picks.unionByName(pick)
    return events.join(F.broadcast(picks), "card_id")


def cutoff_counts(
    events: DataFrame, stops: Sequence[int], lines: Sequence[int], cutoff: float = 0.15, repeat: bool = True
) -> DataFrame:
    """Alightings above and below a confidence cut-off, for journeys boarding at given stops.

    ``repeat`` counts a journey once per such boarding, as the original does;
    otherwise each journey counts once.
    """
    on_lines = F.col("line_id").isin(*lines)
    boardings = events.where(on_lines & F.col("stop_id").isin(*stops) & (F.col("event") == "BOARDED"))
    alightings = events.where(on_lines & (F.col("event") == "ALIGHTED"))
    if repeat:
        # the number of boardings stands for the repeated rows
        times = boardings.groupBy("journey_id").agg(F.count(F.lit(1)).alias("times"))
        counted = alightings.join(times, "journey_id")
    else:
        counted = alightings.join(boardings, "journey_id", "left_semi").withColumn("times", F.lit(1))
    above = F.when(F.col("confidence") > cutoff, "Y").otherwise("N")
    return counted.groupBy(above.alias("above_cutoff")).agg(F.sum("times").alias("n"))


def describe(df: DataFrame, by: Sequence[str], value: str, steps: Sequence[float]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quantiles per group, one row per figure."""
    named = {
        "count": F.count(value).cast("double"),
        "mean": F.avg(value),
        "std": F.stddev_samp(value),
        "min": F.min(value).cast("double"),
        "max": F.max(value).cast("double"),
    }
    moments = df.groupBy(*by).agg(*[c.alias(n) for n, c in named.items()])
    long = moments.select(
        *by, F.inline(F.array(*[F.struct(F.lit(n).alias("statistic"), F.col(n).alias("figure")) for n in named]))
    )
    quantiles = exact_quantiles(df, by, value, steps).select(
        *by,
        F.concat(F.round(F.col("prob") * 100).cast("int").cast("string"), F.lit("%")).alias("statistic"),
        F.col("quantile").alias("figure"),
    )
    return long.unionByName(quantiles)


def histogram(df: DataFrame, by: Sequence[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per group and equal-width bin of ``value``; bin 0 is below, ``bins + 1`` above."""
    bucket = F.width_bucket(F.col(value), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.where(F.col(value).isNotNull()).groupBy(*by, bucket.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _miles() -> Column:
    return F.col("origin_destination_distance_meters") * FEET_PER_METER / FEET_PER_MILE


def impact_table(profiles: DataFrame, above: Column, segment: Column, counts: dict[str, Column]) -> DataFrame:
    """Effect of a cut-off per segment: ``segment``, ``statistic``, all, above, percent change.

    ``above`` says which rows stay; ``counts`` names further row counts.
    """
    rows = profiles.select(
        segment.alias("segment"),
        F.coalesce(above, F.lit(False)).alias("above"),
        _miles().alias("Median Distance (miles)"),
        (F.col("journey_time_seconds") / 60).alias("Median Journey Time (minutes)"),
        F.col("n_legs"),
        *[F.coalesce(c, F.lit(False)).alias(n) for n, c in counts.items()],
    )
    both = rows.withColumn(
        "side", F.explode(F.when(F.col("above"), F.array(F.lit("all"), F.lit("above"))).otherwise(F.array(F.lit("all"))))
    )
    medians_of = ["Median Distance (miles)", "Median Journey Time (minutes)"]
    long = both.select(
        "segment",
        "side",
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("statistic"), F.col(m).cast("double").alias("v")) for m in medians_of])
        ),
    )
    medians = exact_quantiles(long, ["segment", "side", "statistic"], "v", [0.5]).select(
        "segment", "side", "statistic", F.col("quantile").alias("figure")
    )
    everything = F.max(F.when(F.col("side") == "all", F.col("figure"))).alias("all_journeys")
    kept = F.max(F.when(F.col("side") == "above", F.col("figure"))).alias("above_cutoff")
    medians = medians.groupBy("segment", "statistic").agg(everything, kept)

    # both sides of the plain figures come from one pass, without a copy of the rows
    over = F.col("above")
    plain = {
        "Number of Journeys": (F.count(F.lit(1)), F.count_if(over)),
        "Mean Number of Transfers": (F.avg("n_legs") - 1, F.avg(F.when(over, F.col("n_legs"))) - 1),
        **{n: (F.count_if(F.col(n)), F.count_if(F.col(n) & over)) for n in counts},
    }
    some = F.count_if(over) > 0
    figures = [
        F.struct(F.lit(n).alias("statistic"), every.cast("double").alias("all_journeys"), F.when(some, part.cast("double")).alias("above_cutoff"))
        for n, (every, part) in plain.items()
    ]
    tallies = rows.groupBy("segment").agg(F.array(*figures).alias("figures")).select("segment", F.inline("figures"))
    change = F.try_divide((F.col("above_cutoff") - F.col("all_journeys")) * 100, F.col("all_journeys"))
    return medians.unionByName(tallies).withColumn("percent_change", change)


def _mode_counts() -> dict[str, Column]:
    mode = travel_mode()
    return {
        "Bus Only Journeys": ~F.col("includes_platform"),
        "Bus and Platform Journeys": mode == "mixed",
        "Platform Only Journeys": mode == "platform_only",
        "Single Stop Rides": F.col("is_single_stop_ride"),
    }


def validity_impact(profiles: DataFrame, cutoff: float = 0.5) -> DataFrame:
    return impact_table(profiles, F.col("validity_score") > cutoff, F.lit("all"), _mode_counts())


def confidence_impact(profiles: DataFrame, onboard: float = 0.5, platform: float = 0.2) -> DataFrame:
    """By travel mode, each with its cut-off on the lowest confidence of the journey."""
    mode = travel_mode()
    limit = F.when(mode == "onboard_only", F.lit(onboard)).otherwise(F.lit(platform))
    return impact_table(profiles, F.col("confidence_min") > limit, mode, {})


def combined_impact(
    profiles: DataFrame, validity: float = 0.5, onboard: float = 0.5, platform: float = 0.2
) -> DataFrame:
    limit = F.when(F.col("includes_platform"), F.lit(platform)).otherwise(F.lit(onboard))
    above = (F.col("validity_score") > validity) & (F.col("confidence_min") > limit)
    return impact_table(profiles, above, F.lit("all"), _mode_counts())
