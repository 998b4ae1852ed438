"""Vehicles that go on as another trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapweave.functions.windows import GROUP_ROWS, near_window, running_sum, sliced_window

INTERLINE = "INTERLINE"
SINGLE = "SINGLE_LINE"
BLOCK_KEYS = ["service_date", "block_id", "service_id"]


def trip_ends(visits: DataFrame) -> DataFrame:
    """First and last stop and arrival of each trip, one row per date and trip."""

    def end(pick, column: str) -> Column:
        # rows without a value do not count as an end
        at = F.when(F.col(column).isNotNull(), F.struct("stop_sequence", "arrive_datetime"))
        return pick(column, at)

    return visits.groupBy("service_date", "trip_id").agg(
        F.min("route_id").alias("route_id"),
        F.min("service_id").alias("service_id"),
        F.min("block_id").alias("block_id"),
        end(F.min_by, "stop_id").alias("start_stop_id"),
        end(F.max_by, "stop_id").alias("end_stop_id"),
        end(F.min_by, "arrive_datetime").alias("start_datetime"),
        end(F.max_by, "arrive_datetime").alias("end_datetime"),
    )


def link_blocks(
    ends: DataFrame, hot: DataFrame | None = None, rows: int = GROUP_ROWS, null_blocks: bool = True
) -> DataFrame:
    """The next trip of the block, and whether the vehicle interlines with it.

    It does when it starts where this trip ends and the route changes. Trips of a
    day without a block count as one block, as in the original method; without
    ``null_blocks`` they have no next trip.
    """
    if not null_blocks:
        none = ends.where(F.col("block_id").isNull()).withColumns(
            {
                "route_id_next": F.lit(None).cast(ends.schema["route_id"].dataType),
                "start_stop_id_next": F.lit(None).cast(ends.schema["start_stop_id"].dataType),
                "interlines_with_trip_id": F.lit(None).cast(ends.schema["trip_id"].dataType),
            }
        )
        return link_blocks(ends.where(F.col("block_id").isNotNull()), hot, rows).unionByName(none)
    ahead = near_window(
        ends,
        BLOCK_KEYS,
        [F.col("start_datetime"), F.col("trip_id")],
        1,
        lambda w: {"__n": F.lead(F.struct("trip_id", "route_id", "start_stop_id")).over(w)},
        hot,
        rows,
    )
    linked = (F.col("end_stop_id") == F.col("__n.start_stop_id")) & (F.col("route_id") != F.col("__n.route_id"))
    return ahead.withColumns(
        {
            "route_id_next": F.col("__n.route_id"),
            "start_stop_id_next": F.col("__n.start_stop_id"),
            "interlines_with_trip_id": F.when(linked, F.col("__n.trip_id")),
        }
    ).drop("__n")


def chain_trips(blocks: DataFrame, hot: DataFrame | None = None, rows: int = GROUP_ROWS) -> DataFrame:
    """``interlining_trip_id`` for every trip.

    Links only join neighbours of a block, so a chain is a run of rows between
    breaks, found with one running count. The id of a chain is taken from the
    hash of its trip list; a trip alone keeps its own id.
    """
    runs = sliced_window(
        blocks,
        BLOCK_KEYS,
        [F.col("start_datetime"), F.col("trip_id")],
        1,
        [lambda w: {"__break": F.when(F.lag("interlines_with_trip_id").over(w).isNull(), 1).otherwise(0)}],
        {"__run": F.col("__break")},
        hot,
        rows,
    )
    chains = runs.groupBy(*BLOCK_KEYS, "__run").agg(
        F.array_sort(F.collect_list(F.struct("start_datetime", "trip_id"))).alias("c")
    )
    trips = F.col("c.trip_id")
    digest = F.substring(F.sha2(F.to_json(trips), 256), 1, 16)
    chain_id = F.when(F.size(trips) > 1, F.conv(digest, 16, 10).cast("decimal(38,0)")).otherwise(
        trips[0].cast("decimal(38,0)")
    )
    return chains.select("service_date", chain_id.alias("interlining_trip_id"), F.explode(trips).alias("trip_id"))


def run_number(trip_id: Column) -> Column:
    """A 64-bit key for a trip or chain id: cheaper to join and sort than decimal(38,0)."""
    wide = trip_id.cast("decimal(38,0)")
    top = F.lit("9223372036854775807").cast("decimal(38,0)")
    turn = F.lit("18446744073709551616").cast("decimal(38,0)")
    return F.when(wide > top, (wide - turn).cast("decimal(38,0)")).otherwise(wide).cast("long")


# More trips of chains than this are joined, not broadcast.
BROADCAST_TRIPS = 2_000_000


def linked_trips(chains: DataFrame) -> DataFrame:
    """The trips of chains of two and more, with the id of the chain."""
    return chains.where(F.col("interlining_trip_id") != F.col("trip_id"))


def few_linked(chains: DataFrame, most: int = BROADCAST_TRIPS) -> bool:
    """True when the linked trips of the written ``chains`` can be broadcast; the size of that table, which has every trip, does not tell."""
    return linked_trips(chains).count() <= most


def insert_chains(
    visits: DataFrame,
    chains: DataFrame | None,
    allow: bool = True,
    keep_first_stop: bool = False,
    few: bool = False,
) -> DataFrame:
    """Visits with chained trips merged into one long trip.

    Where two trips of a chain meet, the stop is kept once, with the first
    arrival and the second departure. ``keep_first_stop`` also keeps the first
    stop of a chain, which the default drops as the original method does. Only
    visits of chains of two and more trips go through windows. A chain is one row
    of its trips in ``chains``, so its visits are not many. ``few`` linked trips are
    broadcast, and then no visit is shuffled to tell the two sorts apart.
    """
    if not allow:
        return visits.withColumns(
            {"trip_type": F.lit(SINGLE), "stop_type": F.lit(SINGLE), "run_id": run_number(F.col("trip_id"))}
        )
    linked = F.broadcast(linked_trips(chains)) if few else linked_trips(chains)
    trip_keys = ["service_date", "trip_id"]
    whole = F.col("trip_id").cast("decimal(38,0)")
    alone = visits.join(linked, trip_keys, "left_anti").withColumns(
        {"trip_type": F.lit(SINGLE), "stop_type": F.lit(SINGLE), "run_id": run_number(whole), "trip_id": whole}
    )
    named = visits.join(linked, trip_keys).withColumns(
        {
            "trip_type": F.lit(INTERLINE),
            "__leg_trip": F.col("trip_id"),
            "run_id": run_number(F.col("interlining_trip_id")),
            "trip_id": F.col("interlining_trip_id"),
        }
    ).drop("interlining_trip_id")

    present = {c.lower() for c in visits.columns}
    departures = [
        c for c in ("departure_datetime", "departure_time", "scheduled_departure_time") if c in present
    ]
    near = near_window(
        named,
        ["service_date", "run_id"],
        [F.col("arrive_datetime"), F.col("departure_datetime"), F.col("__leg_trip"), F.col("stop_sequence")],
        1,
        lambda w: {
            "__prev": F.lag("stop_id").over(w),
            "__next": F.lead(F.struct("stop_id", *departures)).over(w),
        },
    )
    meets = F.coalesce(F.col("__next.stop_id") == F.col("stop_id"), F.lit(False))
    merged = near.withColumns(
        {
            "stop_type": F.when(meets, INTERLINE).otherwise(SINGLE),
            **{c: F.when(meets, F.col("__next")[c]).otherwise(F.col(c)) for c in departures},
        }
    )
    fresh = F.col("__prev") != F.col("stop_id")
    if keep_first_stop:
        fresh = F.col("__prev").isNull() | fresh
    counted = running_sum(
        merged.where(fresh), ["service_date", "run_id"],
        [F.col("arrive_datetime"), F.col("__leg_trip"), F.col("stop_sequence")], F.lit(1), "__place",
    )
    chained = counted.withColumn("stop_sequence", F.col("__place").cast("int")).drop("__prev", "__next", "__place", "__leg_trip")
    return alone.unionByName(chained)


def interline_stops(visits: DataFrame) -> DataFrame:
    """The places where a chain passes from one trip to the next."""
    return visits.where(F.col("stop_type") == INTERLINE).select(
        F.col("service_date").alias("interline_date"),
        F.col("run_id").alias("interline_run"),
        F.col("stop_sequence").alias("interline_sequence"),
        F.col("stop_id").alias("interline_stop_id"),
        F.col("stop_lat").alias("interline_stop_lat"),
        F.col("stop_lon").alias("interline_stop_lon"),
        F.col("arrive_datetime").alias("interline_arrive"),
        F.col("departure_datetime").alias("interline_departure"),
    )


def interline_events(legs: DataFrame, visits: DataFrame, allow: bool = True) -> DataFrame:
    """Legs that change route, once per interline stop strictly inside the ride."""
    changing = legs.where(F.col("board_route") != F.col("alight_route"))
    places = interline_stops(visits)
    if not allow:
        places = places.where(F.lit(False))
    on = (
        (F.col("service_date") == F.col("interline_date"))
        & (F.col("run_id") == F.col("interline_run"))
        & (F.col("interline_sequence") > F.col("board_sequence"))
        & (F.col("interline_sequence") < F.col("alight_sequence"))
    )
    return changing.join(places, on).drop("interline_date", "interline_run")
