"""Small generic operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    if len(frames) < 2:
        raise ValueError("need at least two frames to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; ranks are cut before the shuffle as well."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(window)).where(F.col("__n") <= k).drop("__n")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1)


def stats(value: str) -> list[Column]:
    """min, max, mean, sum and count of a column."""
    return [
        f(value).alias(f"{value}_{name}")
        for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("sum", F.sum), ("count", F.count))
    ]
