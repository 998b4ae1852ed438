"""Input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared schemas of the schedule files that have one.
CALENDAR_DATES = "service_id string, date integer, exception_type integer"
FEED_FILES = (
    "agency",
    "calendar",
    "calendar_dates",
    "fare_attributes",
    "fare_rules",
    "feed_info",
    "linked_datasets",
    "route_directions",
    "routes",
    "shapes",
    "stop_features",
    "stop_times",
    "stops",
    "transfers",
    "trips",
)


def read_parquet(spark: SparkSession, folder: str, pattern: str | None = None) -> DataFrame:
    """Parquet files of a folder whose names match ``pattern``, e.g. ``*.parquet.gzip``."""
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def read_csv(spark: SparkSession, folder: str, schema: str | None = None, pattern: str | None = None) -> DataFrame:
    """Delimited files with a header, gzip included. Without a schema it is inferred, at one more pass."""
    reader = spark.read.option("header", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(folder)


def read_feed(
    spark: SparkSession,
    folder: str,
    kind: str,
    fmt: str = "parquet",
    schema: str | None = None,
    landed: bool = False,
) -> DataFrame:
    """One kind of schedule file over all releases, with ``RELEASE_DATE`` as a column.

    Reads folders ``RELEASE_DATE=...`` that hold one file per kind, or with
    ``landed`` the tables that ``sinks.land_release`` writes per kind.
    """
    if kind not in FEED_FILES:
        raise ValueError(f"unknown feed file {kind!r}")
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
        reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    if landed:
        return reader.format(fmt).load(f"{folder}/{kind}")
    suffix = {"parquet": "parquet", "csv": "txt*"}[fmt]
    return reader.option("basePath", folder).option("pathGlobFilter", f"*{kind}.{suffix}").format(fmt).load(folder)
