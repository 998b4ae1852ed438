"""Schedule feeds expanded to service days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_number_to_date(column: str) -> Column:
    """``yyyymmdd`` integers as dates."""
    return F.try_to_timestamp(F.col(column).cast("string"), F.lit("yyyyMMdd")).cast("date")


def calendar_dates_of_services(calendar: DataFrame) -> DataFrame:
    """Every date of a service between its start and end, as an array."""
    dated = calendar.withColumns({c: day_number_to_date(c) for c in ("start_date", "end_date")})
    ordered = F.col("start_date") <= F.col("end_date")
    days = F.sequence("start_date", "end_date", F.expr("interval 1 day"))
    return dated.withColumn("valid_dates", F.when(ordered, days).otherwise(F.array().cast("array<date>")))


def all_releases(feed: DataFrame) -> DataFrame:
    """Rows of a feed file over all releases, exact repeats once."""
    return feed.drop("release_date").distinct()


def active_services(calendar_dates: DataFrame) -> DataFrame:
    added = calendar_dates.where(F.col("exception_type") == 1)
    return added.select(F.col("service_id").cast("string").alias("service_id")).distinct()


def active_trips(calendar_dates: DataFrame, trips: DataFrame) -> DataFrame:
    services = active_services(calendar_dates)
    return trips.join(services, "service_id", "left_semi").select(F.col("trip_id").cast("int").alias("trip_id")).distinct()


def between_dates(calendar_dates: DataFrame, first: str, last: str) -> DataFrame:
    day = day_number_to_date("date")
    return calendar_dates.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def services_per_date(calendar_dates: DataFrame) -> DataFrame:
    return calendar_dates.groupBy("date").agg(F.sort_array(F.collect_set("service_id")).alias("service_ids"))


def expand_schedule(calendar_dates: DataFrame, trips: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Scheduled stop times once per service date, shaped like vehicle stop events.

    Trips must belong to a service that is active on some date; the dates of a
    service are all those listed, whatever their exception type.
    """
    running = trips.select("trip_id", "service_id").distinct().join(
        active_services(calendar_dates), "service_id", "left_semi"
    )
    dates = calendar_dates.select("service_id", day_number_to_date("date").alias("service_date")).distinct()
    times = stop_times.select("trip_id", "stop_id", "stop_sequence", "arrival_time", "departure_time").distinct()
    dated = running.join(dates, "service_id").join(times, "trip_id")
    return dated.select(
        F.col("trip_id").cast("int").alias("trip_id"),
        F.col("stop_id").cast("string").alias("stop_id"),
        F.col("stop_sequence").cast("int").alias("stop_sequence"),
        F.col("arrival_time").alias("scheduled_arrive_time"),
        F.col("departure_time").alias("scheduled_departure_time"),
        F.col("arrival_time").alias("actual_arrive_time"),
        F.col("departure_time").alias("actual_departure_time"),
        "service_date",
    )
