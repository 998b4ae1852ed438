"""Vehicle stop events ("visits"): clocks, trip data, locations, headways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tapweave.functions.clock import clock_parts, clock_time, epoch
from tapweave.functions.stage import noted, stage
from tapweave.functions.windows import GROUP_ROWS, keep_matching, left_lookup, near_window, sliced_window


def add_visit_times(visits: DataFrame) -> DataFrame:
    """Arrival and departure timestamps from the service-day clocks.

    In steps: the clocks are used several times each, and in one expression they would be split and read as often.
    """
    named = visits.withColumnsRenamed(
        {"actual_arrive_time": "arrive_time", "actual_departure_time": "departure_time"}
    ).withColumn("stop_id", F.col("stop_id").try_cast("int"))
    ends = ("arrive", "departure")
    split = named.withColumns({f"__{e}": F.split(f"{e}_time", ":") for e in ends})
    read = split.withColumns({f"__{e}_{u}": c for e in ends for u, c in zip("hms", clock_parts(F.col(f"__{e}")))})
    timed = read.withColumns(
        {f"{e}_datetime": clock_time("service_date", *[F.col(f"__{e}_{u}") for u in "hms"]) for e in ends}
    )
    return timed.drop(*[f"__{e}{u}" for e in ends for u in ("", "_h", "_m", "_s")])


def keep_tapped_dates(visits: DataFrame, taps: DataFrame) -> DataFrame:
    """Visits of service dates that have taps.

    The distinct dates number one per calendar day, so broadcasting them is
    bounded, and the semi join prunes date partitions at run time.
    """
    return visits.join(F.broadcast(taps.select("service_date").distinct()), "service_date", "left_semi")


_TRIP_COLUMNS = ("route_id", "service_id", "direction_id", "block_id")


def unique_trips(trips: DataFrame) -> DataFrame:
    """One row per trip id; the smallest values win when a trip is listed twice."""
    return (
        trips.groupBy("trip_id")
        .agg(F.min(F.struct(*_TRIP_COLUMNS)).alias("t"))
        .select("trip_id", *[F.col("t")[c].alias(c) for c in _TRIP_COLUMNS])
    )


def add_trip_data(visits: DataFrame, trips: DataFrame, numbered: bool = False) -> DataFrame:
    """Visits with the data of their trip; ``numbered`` adds ``__route``, the route's number, read once per trip."""
    known = unique_trips(trips)
    return visits.join(known.withColumn("__route", _route_number()) if numbered else known, "trip_id", "left")


def _route_number() -> Column:
    return F.regexp_replace("route_id", "[a-z]", "").try_cast("int")


def dates_without_trip_data(visits: DataFrame, trips: DataFrame) -> DataFrame:
    """Service dates with visits whose trip is not in the schedule."""
    known = trips.where(F.col("route_id").isNotNull())
    return visits.join(known, "trip_id", "left_anti").select("service_date").distinct()


def numeric_routes(visits: DataFrame) -> DataFrame:
    """``81a`` becomes 81; a route id that is still no number becomes null."""
    if "__route" in visits.columns:
        return visits.withColumn("route_id", F.col("__route")).drop("__route")
    return visits.withColumn("route_id", _route_number())


def watch_trip_data(joined: DataFrame, watch: Observation) -> DataFrame:
    """Visits with trip data and text route ids, whose faults ``watch`` notes while somebody writes them."""
    text = F.col("route_id")
    number = F.col("__route") if "__route" in joined.columns else _route_number()
    return joined.observe(
        watch,
        # one date per calendar day at most
        F.collect_set(F.when(text.isNull(), F.col("service_date").cast("string"))).alias("missing"),
        F.count_if(text.isNotNull() & number.isNull()).alias("odd"),
    )


def require_watched(watch: Observation) -> None:
    """An error when trips were missing or route ids not numeric; call it after the write and before the use."""
    seen = noted(watch)
    if seen.get("missing"):
        raise ValueError(f"no schedule data for trips on {', '.join(sorted(seen['missing']))}")
    if seen.get("odd"):
        raise ValueError("route ids left that are not numeric")


def require_trip_data(visits: DataFrame, trips: DataFrame) -> DataFrame:
    """The visits, or an error when trips are missing or route ids are not numeric.

    A job of its own over ``trip_id`` and ``service_date``; where the visits are
    written anyway, ``watch_trip_data`` takes no second join.
    """
    watch = Observation()
    narrow = visits.select("trip_id", "service_date")
    watch_trip_data(add_trip_data(narrow, trips), watch).write.format("noop").mode("overwrite").save()
    require_watched(watch)
    return visits


def add_source(df: DataFrame, value: str) -> DataFrame:
    if "source" in (c.lower() for c in df.columns):
        raise ValueError("column 'source' exists already")
    return df.withColumn("source", F.lit(value))


def location_periods(stops: DataFrame) -> DataFrame:
    """Doubled day numbers between which each release of a stop is the nearest one.

    A date ``d`` belongs to the release with ``after < 2 d <= upto`` (null is
    open); of two releases equally near, the earlier one counts.
    """
    places = (
        stops.groupBy("stop_id", "release_date")
        .agg(F.min(F.struct("stop_lat", "stop_lon")).alias("p"))
        .select(
            F.col("stop_id").try_cast("int").alias("stop_id"),
            F.unix_date("release_date").alias("day"),
            "p.stop_lat",
            "p.stop_lon",
        )
    )
    order = Window.partitionBy("stop_id").orderBy("day")
    return places.withColumns(
        {
            "after": F.lag("day").over(order) + F.col("day"),
            "upto": F.lead("day").over(order) + F.col("day"),
        }
    ).drop("day")


def _in_period(date: str) -> Column:
    twice = F.unix_date(date) * 2
    return (F.col("after").isNull() | (twice > F.col("after"))) & (F.col("upto").isNull() | (twice <= F.col("upto")))


def stop_positions(stops: DataFrame, dates: DataFrame) -> DataFrame:
    """Stop position on each of ``dates``, from the release nearest to it: ``__stop``, ``__date`` and position."""
    periods = location_periods(stops).withColumnRenamed("stop_id", "__stop")
    days = F.broadcast(dates.select(F.col("service_date").alias("__date")).distinct())
    return periods.join(days, _in_period("__date")).drop("after", "upto")


def place_visits(visits: DataFrame, positions: DataFrame) -> DataFrame:
    """Visits with the position of their stop and date, see ``stop_positions``."""
    on = (F.col("stop_id") == F.col("__stop")) & (F.col("service_date") == F.col("__date"))
    return visits.join(positions, on, "left").drop("__stop", "__date")


def add_stop_locations(visits: DataFrame, stops: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Stop position from the release nearest to the service date.

    The periods of a stop do not overlap, so the join finds at most one row per
    visit and no choice among candidates is left to make. With ``dates`` (the
    distinct service dates of the visits, one per calendar day) the positions are
    resolved per stop and date first, and the visits are joined on both: if the
    positions are too many to broadcast, a busy stop is as many keys as it has days.
    """
    if dates is None:
        periods = location_periods(stops).withColumnRenamed("stop_id", "__stop")
        on = (F.col("stop_id") == F.col("__stop")) & _in_period("service_date")
        return visits.join(periods, on, "left").drop("__stop", "after", "upto")
    # dealt by both, or the visits would follow the periods' layout by stop alone
    return place_visits(visits, stop_positions(stops, dates).repartition("__stop", "__date"))


def mark_repeated_stops(visits: DataFrame, hot: DataFrame | None = None, rows: int = GROUP_ROWS) -> DataFrame:
    """``is_repeated``: the next visit of the trip is at the same stop.

    A trip id fixes route, service and direction, so date and trip are the key.
    """
    following = near_window(
        visits,
        TRIP_KEYS,
        [F.col("arrive_datetime"), F.col("stop_sequence")],
        1,
        lambda w: {"__following": F.lead("stop_id").over(w)},
        hot,
        rows,
    )
    repeated = F.coalesce(F.col("__following") == F.col("stop_id"), F.lit(False))
    return following.withColumn("is_repeated", repeated).drop("__following")


def drop_repeated_stops(marked: DataFrame) -> DataFrame:
    return marked.where(~F.col("is_repeated")).drop("is_repeated")


def merge_repeated_stops(visits: DataFrame, hot: DataFrame | None = None, rows: int = GROUP_ROWS) -> DataFrame:
    """Of consecutive visits of one stop within a trip keep the last."""
    return drop_repeated_stops(mark_repeated_stops(visits, hot, rows))


TRIP_KEYS = ["service_date", "trip_id"]
HEADWAY_KEYS = ["route_id", "stop_id", "service_date", "direction_id"]


def first_intervals(visits: DataFrame, hot: DataFrame) -> DataFrame:
    """Seconds between the first two arrivals of the groups named by ``hot``."""
    second = epoch("arrive_datetime")
    # null keys match too: a missing direction is a group like any other
    of_hot = keep_matching(visits.where(F.col("arrive_datetime").isNotNull()), HEADWAY_KEYS, F.broadcast(hot))
    times = of_hot.groupBy(*HEADWAY_KEYS, second.alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    first = F.min(F.struct("__s", "__n")).over(Window.partitionBy(*HEADWAY_KEYS))
    gap = F.when(F.col("__f.__n") > 1, F.lit(0)).otherwise(F.col("__s") - F.col("__f.__s"))
    later = (F.col("__s") > F.col("__f.__s")) | (F.col("__f.__n") > 1)
    return times.withColumn("__f", first).groupBy(*HEADWAY_KEYS).agg(F.min(F.when(later, gap)).cast("double").alias("__opening"))


def add_headways(visits: DataFrame, hot: DataFrame | None = None, rows: int = GROUP_ROWS) -> DataFrame:
    """Mean seconds between vehicles, over two visits back and ahead, not below 60.

    Visits without any interval in reach take the first interval of their
    group; that only happens to lone visits (null) and to leading visits
    without an arrival time.
    """
    second = epoch("arrive_datetime")
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    out = sliced_window(
        visits,
        HEADWAY_KEYS,
        [F.col("arrive_datetime"), F.col("trip_id"), F.col("stop_sequence")],
        3,
        [
            lambda w: {"arrival_delta": second - F.lag(second).over(w)},
            lambda w: {
                "__mean": F.avg("arrival_delta").over(w.rowsBetween(-2, 2)),
                "__first": F.first("arrival_delta", ignorenulls=True).over(w.rowsBetween(*whole)),
            },
        ],
        hot=hot,
        rows=rows,
    )
    mean, opening = F.col("__mean"), F.col("__first").cast("double")
    if hot is not None:  # a slice does not know its group's first interval
        out = left_lookup(out, HEADWAY_KEYS, F.broadcast(stage(first_intervals(visits, hot), "openings")))
        opening = F.coalesce("__opening", opening)
    headway = F.when(mean < 60, F.lit(60.0)).otherwise(F.coalesce(mean, opening))
    return out.withColumn("mean_boarding_interval_seconds", headway).drop("__mean", "__first", "__opening")


def add_hour(visits: DataFrame) -> DataFrame:
    return visits.withColumn("hour", F.hour("arrive_datetime"))


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Cluster rows by columns ahead of a partitioned write.

    A rebalance lets adaptive execution split the rows of a heavy value over
    several tasks and put light values together.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])
