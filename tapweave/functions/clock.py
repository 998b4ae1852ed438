"""Time helpers: service-day clocks, epoch seconds, time slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def epoch(ts: str | Column) -> Column:
    """Whole epoch seconds of a timestamp."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("long")


def service_clock(date: str | Column, clock: str | Column) -> Column:
    """``HH:MM:SS`` on a service day as a timestamp.

    Hours 24 to 47 fall on the next calendar day. Anything that is no such
    clock gives null.
    """
    return clock_time(date, *clock_parts(F.split(clock, ":")))


def clock_parts(parts: Column) -> list[Column]:
    """Hour, minute and second of a clock split at its colons."""
    return [F.get(parts, F.lit(i)).try_cast("int") for i in range(3)]


def clock_time(date: str | Column, hour: Column, minute: Column, second: Column) -> Column:
    """See ``service_clock``; over columns of hour, minute and second none is parsed twice."""
    valid = hour.between(0, 47) & minute.between(0, 59) & second.between(0, 59)
    day = F.col(date) if isinstance(date, str) else date
    seconds = F.unix_date(day.cast("date")).cast("long") * DAY_SECONDS + hour * 3600 + minute * 60 + second
    return F.when(valid, F.timestamp_seconds(seconds))


def service_slice(date: Column, second: Column, width: int, days: int = 2) -> Column:
    """Number of the ``width``-second slice of a service day.

    Times before the day or after ``days`` days go to the first or last slice,
    so the numbering is monotone in time and never leaves a fixed range.
    """
    last = days * DAY_SECONDS // width - 1
    start = F.unix_date(date).cast("long") * DAY_SECONDS
    number = F.floor((second - start) / width)
    inside = F.greatest(F.lit(0), F.least(F.lit(last), number)).cast("int")
    return F.when(number.isNotNull(), inside)
