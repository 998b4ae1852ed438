"""The corpus pipeline: toxicity, exact copies, near copies, mixing, packing.

Each stage gets the documents its predecessor kept, written and read again, and
returns documents with the same columns; the last returns the packed pieces.
SQL can't express the fitted classifier of the first stage, so there is no SQL
for the whole run; the stages are tested one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapweave.functions.stage import Stages
from tapweave.llm import exactdup, mixing, neardup, packing, toxicity
from tapweave.llm.common import table
from tapweave.llm.queries import held_out

# Jaccard similarity of five-word shingles from which documents are near copies.
NEAR = neardup.NearDup(percent=80, bands=50, rows=7)

# Half of the tokens that reach the mixing; what the mixture has too little of is kept whole.
MIX = mixing.Mix(budget=0.5)


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out(5, 0))
    return toxicity.with_score(docs, model, score="__score", predicted="__toxic").where("__toxic = 0").select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exactdup.keep_first(docs, Stages(spark))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.keep_one(docs, Stages(spark), NEAR)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, with the raked shares of source, language and topic as far as there are tokens for them."""
    return mixing.sample(docs, MIX, Stages(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack(docs, Stages(spark))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    stages = Stages(spark)
    for name, apply in STAGES[:-1]:
        docs = stages.write(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
