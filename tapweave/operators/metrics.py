"""Figures that describe a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def failure_reasons(failed: DataFrame) -> DataFrame:
    """Number of distinct (date, journey) pairs per reason."""
    told = failed.select("service_date", "journey_id", F.explode("reasons_for_impossibility").alias("reason"))
    return told.distinct().groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def run_metrics(events: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per figure: ``metric``, ``value``.

    ``events`` are the rider events of the run, ``failed`` its impossible legs.
    """
    per_journey = events.groupBy("journey_id").agg(
        F.max(F.when(F.col("event").contains("INTERLINE"), 1).otherwise(0)).alias("interlined"),
        F.sum(F.when(F.col("event") == "ALIGHTED", F.col("confidence"))).alias("confidence"),
        F.count_if(F.col("event") == "ALIGHTED").alias("alightings"),
    )
    good = per_journey.agg(
        F.count(F.lit(1)).alias("ok"),
        F.sum("interlined").alias("interlined"),
        F.try_divide(F.sum("confidence"), F.sum("alightings").cast("double")).alias("mean_confidence"),
    )
    bad = failed.agg(F.count_distinct("journey_id").alias("bad"))
    # both sides are single rows
    both = good.crossJoin(F.broadcast(bad))
    all_journeys = F.col("ok") + F.col("bad")

    def percent(part, of):
        return F.floor(F.try_divide(100 * part, of)).cast("double")

    figures = {
        "N_SUCCESSFUL": F.col("ok").cast("double"),
        "N_FAILED": F.col("bad").cast("double"),
        "PERCENT_FAILED": percent(F.col("bad"), all_journeys),
        "MEAN_CONFIDENCE": F.col("mean_confidence"),
        "PERCENT_INTERLINE": percent(F.col("interlined"), F.col("ok")),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in figures.items()])
    by_reason = failure_reasons(failed).select(F.col("reason").alias("metric"), F.col("n").cast("double").alias("value"))
    return both.select(F.inline(rows)).unionByName(by_reason)
