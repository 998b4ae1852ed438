"""Output tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapweave.operators.taps import upper_case_columns
from tapweave.operators.visits import spread_by
from tapweave.sources.readers import read_csv


def write_partitioned(df: DataFrame, path: str, *keys: str, compression: str = "zstd") -> None:
    """Overwrite the partitions that ``df`` has rows for; other partitions stay.

    Rows are clustered by the keys first, and heavy partitions are split over
    several files.
    """
    (
        spread_by(df, *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*keys)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, *keys: str, compression: str = "zstd") -> None:
    """``write_partitioned`` with the upper-case column names of the published tables."""
    write_partitioned(upper_case_columns(df), path, *[k.upper() for k in keys], compression=compression)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """The metric rows as one JSON object of name and value."""
    pairs = F.map_from_entries(F.collect_list(F.struct("metric", "value")))
    metrics.agg(F.to_json(pairs).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def land_release(
    spark: SparkSession, text_path: str, target: str, kind: str, release_date: str, schema: str | None = None
) -> None:
    """Convert the text file of one kind of a feed release to parquet.

    Goes to ``target/kind/RELEASE_DATE=...``; other releases there stay.
    """
    frame = read_csv(spark, text_path, schema)
    frame.write.mode("overwrite").parquet(f"{target}/{kind}/RELEASE_DATE={release_date}")
