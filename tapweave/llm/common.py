"""Small helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows handed to Python at once. Texts may be very long, so batches are small.
ARROW_ROWS = 256

# Distinct key hashes kept by ``likely``: the largest broadcast it can cause.
KEY_HASHES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, with small Arrow batches for the session's Python steps."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_crc(name: str = "doc_id") -> Column:
    """crc32 of the id written as text; null ids count as 0."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(0))


def likely(df: DataFrame, keys: DataFrame, name: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key may occur in ``keys``, without a shuffle of ``df``.

    A key is reduced to one of ``KEY_HASHES`` values, so the broadcast side has
    at most that many integers whatever the size of ``keys``. Some other rows
    pass too, a join on the key itself has to follow. ``how="left_anti"`` gives
    rows whose key is surely absent.
    """
    cell = F.pmod(F.xxhash64(name), F.lit(KEY_HASHES)).cast("int")
    marks = keys.select(cell.alias("__cell")).distinct()
    return df.withColumn("__cell", cell).join(F.broadcast(marks), "__cell", how).drop("__cell")
