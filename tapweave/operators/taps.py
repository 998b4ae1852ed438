"""Fare-card taps: checks, cleaning, legs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapweave.config import PLATFORM_LINE
from tapweave.functions.clock import epoch


def upper_case_columns(df: DataFrame) -> DataFrame:
    """All column names in upper case."""
    return df.toDF(*[name.upper() for name in df.columns])


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of nulls, from a single pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns])
    return counted.select(F.inline(pairs))


def require_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error that names the columns holding nulls."""
    bad = [r.column_name for r in null_counts(df, columns).where("n_null > 0").collect()]
    if bad:
        raise ValueError(f"nulls found in {', '.join(bad)}")
    return df


def fill_unknown_ticket(df: DataFrame) -> DataFrame:
    return df.fillna("Unknown", subset=["transaction_ticket_description"])


def alias_lines(df: DataFrame, aliases: Mapping[int, int], column: str, keep_old: bool = True) -> DataFrame:
    """Replace line ids by their alias; the id before goes to ``<column>_old``."""
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    mapped = F.coalesce(F.try_element_at(table, F.col(column)), F.col(column))
    new = {column: mapped}
    if keep_old:
        new[f"{column}_old"] = F.col(column)
    return df.withColumns(new)


def drop_unknown_stops(df: DataFrame) -> DataFrame:
    return df.where(F.col("stop_id") != -1)


def parse_datetime(df: DataFrame, column: str = "tap_time") -> DataFrame:
    return df.withColumn("datetime", F.try_to_timestamp(F.col(column).cast("string")))


def add_date(df: DataFrame, column: str = "datetime", pattern: str | None = None) -> DataFrame:
    """``date`` from a date-like column, optionally read with ``pattern``."""
    text = F.col(column).cast("string")
    if pattern:
        return df.withColumn("date", F.try_to_timestamp(text, F.lit(pattern)).cast("date"))
    return df.withColumn("date", F.col(column).try_cast("date"))


def tag_unwanted_operators(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Listed or missing operators are unwanted."""
    listed = F.col("operatedby_description").isin(*names)
    return df.withColumn("is_unwanted_operator", F.coalesce(listed, F.lit(True)))


def latest_month(df: DataFrame, column: str) -> Column:
    """First day of the latest month of a date-like column, as a scalar subquery: nothing is fetched to the driver."""
    return df.agg(F.trunc(F.max(F.col(column).cast("date")), "MM")).scalar()


def select_months(
    df: DataFrame, column: str, year_months: Sequence[Sequence[int]] | int = -1, latest: Column | None = None, margin: int = 0
) -> DataFrame:
    """Rows of the listed ``(year, month)`` pairs, or of the latest month present for -1.

    ``latest`` is the month to take for -1 if it is not that of ``df``. With
    ``margin``, that many days before and after each month stay too. Both forms
    prune a table partitioned by the column.
    """
    if isinstance(year_months, (list, tuple)):
        months = [F.make_date(F.lit(y), F.lit(m), F.lit(1)) for y, m in year_months]
    elif year_months == -1:
        months = [latest_month(df, column) if latest is None else latest]
    else:
        raise ValueError(f"expected (year, month) pairs or -1, got {year_months!r}")
    inside = F.lit(False)
    for month in months:
        day = F.col(column)
        inside = inside | ((day >= F.date_sub(month, margin)) & (day < F.date_add(F.add_months(month, 1), margin)))
    return df.where(inside)


# Columns that make the order of taps of one card total. A unique row id, when
# the table has one, is enough; otherwise the content decides.
_TIE_COLUMNS = ("event_id", "line_id", "stop_id", "direction_id", "operatedby_description")


def tap_ties(df: DataFrame) -> list[Column]:
    present = {c.lower() for c in df.columns}
    return [F.col(c) for c in _TIE_COLUMNS if c in present]


def drop_bursts(df: DataFrame, seconds: int = 20, slice_seconds: int = 900) -> DataFrame:
    """Keep the last tap of every burst of one card.

    A tap goes when the card's next tap comes less than ``seconds`` later. Only
    that much time ahead matters, so each card is cut into time slices and the
    first ``seconds`` of a slice are shown to the slice before as well: a card
    with any number of taps spreads over many tasks, at one shuffle. What
    remains has at most one tap per card and ``seconds``, which bounds every
    later per-card window.
    """
    width = max(slice_seconds, seconds)
    at = epoch("datetime")
    here = F.floor(at / width)
    views = F.when(
        F.pmod(at, F.lit(width)) < seconds,
        F.array(F.struct(here.alias("part"), F.lit(False).alias("ahead")),
                F.struct((here - 1).alias("part"), F.lit(True).alias("ahead"))),
    ).otherwise(F.array(F.struct(here.alias("part"), F.lit(False).alias("ahead"))))
    shown = df.select("*", F.inline(views))
    order = Window.partitionBy("card_id", "part").orderBy("datetime", *tap_ties(df))
    gap = F.lead(at).over(order) - at
    return (
        shown.withColumn("__gap", gap)
        .where(~F.col("ahead") & (F.col("__gap").isNull() | (F.col("__gap") >= seconds)))
        .drop("part", "ahead", "__gap")
    )


def locate_taps(taps: DataFrame, visits: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Mean position of the tapped stop, null where the stop has no visit.

    ``places`` are the positions where they are written already: their size is
    known then, so Spark can tell whether to broadcast them.
    """
    places = mean_stop_locations(visits) if places is None else places
    return taps.where(F.col("stop_id") != -1).join(places, "stop_id", "left")


def mean_stop_locations(visits: DataFrame) -> DataFrame:
    """Mean position per stop, to a billionth of a degree (a tenth of a millimeter).

    The rounding hides the order of summation, which differs from run to run:
    without it a distance of zero comes out as noise, and scores that divide by
    it as anything.
    """
    return (
        visits.where(F.col("stop_id").isNotNull())
        .groupBy("stop_id")
        .agg(*[F.round(F.avg(c), 9).alias(c) for c in ("stop_lat", "stop_lon")])
    )


def pair_with_next(taps: DataFrame, columns: Sequence[str], rider: str = "card_id") -> DataFrame:
    """Legs: each tap with the retained columns of the rider's next tap as ``<column>_next``."""
    present = {c.lower() for c in taps.columns}
    kept = [c for c in columns if c.lower() in present]
    order = Window.partitionBy(rider).orderBy("datetime", *tap_ties(taps))
    ahead = F.lead(F.struct(*kept)).over(order)
    nexts = [F.col("__next")[c].alias(f"{c}_next") for c in kept]
    # dealt ahead of the window, or the structs it looks at would be shuffled beside their columns
    return taps.repartition(rider).select(rider, *kept, ahead.alias("__next")).select(rider, *kept, *nexts)


def tag_mode(legs: DataFrame) -> DataFrame:
    """``mode`` of the tap and a ``tap_id`` hash."""
    return legs.withColumns(
        {
            "mode": F.when(F.col("line_id") == PLATFORM_LINE, "platform").when(
                F.col("line_id") != PLATFORM_LINE, "onboard"
            ),
            "tap_id": F.sha2(F.concat(F.col("card_id").cast("string"), F.col("datetime").cast("string")), 256),
        }
    )
