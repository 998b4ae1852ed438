"""Mixing sources to target weights by iterative proportional fitting.

Documents are counted into cells of source, language and topic. The token
weights of the cells are raked: one margin after the other is scaled to its
target shares, in several sweeps. A cell's weight per token is then a sampling
probability, and a document stays if a hash of its id falls below it. No document
is repeated.

Without ``Mix.budget`` the largest probability becomes 1, so in expectation the
kept tokens have the raked margins exactly, and the scarcest cell says how many
tokens that are. With a budget (a share of all tokens) a probability is
``min(1, c * rate)``, ``c`` such that the expected tokens meet the budget. Cells
at 1 stay whole, and the raking lets the others of their margin values make up
for what these lack; a value without enough tokens stays short of its target.

Everything is built from DataFrame operations. Only the cells (distinct
combinations, pre-aggregated in each task) are iterated on; they are written
after each step with the factors of their margins.

Defined results: null sources, languages and topics are values of their own
(shown as empty text); a null or empty text has one token; a null id has the
hash of the empty text; repeated rows share their fate; an empty table gives no
rows; other columns are passed through, whatever their names (``calibrated``
replaces those named like its results). A margin value without a target gets its
tempered natural share.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages
from tapweave.llm.common import text_or_empty

MARGINS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Mix:
    """``temper``: exponent on the natural token shares of a margin, which makes the default
    targets (1 keeps them, 0 makes all values equal). ``targets`` replaces it for a whole margin.
    ``budget``: share of all tokens to keep; without one, as many as the scarcest cell allows."""

    temper: Mapping[str, float] = field(default_factory=lambda: {"source": 0.7, "lang": 0.8, "topic": 0.8})
    targets: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    sweeps: int = 5
    budget: float | None = None


def tokens(text: Column) -> Column:
    """Tokens of a text, estimated by its size: one per four characters, one at least."""
    return F.greatest(F.lit(1), F.ceil(F.length(text) / 4)).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from the form of a text: table, list, shouting, data, note, article, essay or book."""
    size = F.length(text)

    def many(chars: str, share: float) -> Column:
        return size - F.length(F.translate(text, chars, "")) > size * share

    by_size = F.when(size < 500, "note").when(size < 3000, "article").when(size < 12000, "essay").otherwise("book")
    marked = (
        F.when(many("|", 0.02), "table")
        .when(many("!", 0.02), "shouting")
        .when(many("#$%&*<>=", 0.02), "symbols")
        .when(many("0123456789", 0.05), "data")
        .otherwise(by_size)
    )
    # most texts have few of all these characters together, which one count tells
    return F.when(many("|!#$%&*<>=0123456789", 0.02), marked).otherwise(by_size)


def uniform(key: str = "doc_id") -> Column:
    """A number from 0 to 1 that depends on the id only."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _values() -> dict[str, Column]:
    return {m: F.coalesce(F.col(m).cast("string"), F.lit("")) for m in ("source", "lang")}


def described(docs: DataFrame) -> DataFrame:
    """Add ``__source``, ``__lang``, ``__topic`` and ``__tokens``."""
    named = {f"__{k}": v for k, v in _values().items()}
    return docs.withColumns(named | {"__topic": topic(text_or_empty()), "__tokens": tokens(text_or_empty())})


def targets(cells: DataFrame, margin: str, mix: Mix) -> DataFrame:
    """Value and target share of one margin."""
    given = mix.targets.get(margin)
    natural = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("n"))
    if given is None:
        share = F.pow("n", F.lit(float(mix.temper[margin])))
    else:
        share = F.lit(None).cast("double")
        for value, weight in given.items():
            share = F.when(F.col(margin) == value, float(weight)).otherwise(share)
        share = F.coalesce(share, F.lit(0.0))
    raw = natural.select(margin, share.alias("raw"))
    total = raw.agg(F.sum("raw")).first()[0] or 1.0
    return raw.select(margin, (F.col("raw") / F.lit(total)).alias(f"target_{margin}"))


def rake(cells: DataFrame, mix: Mix, stages: Stages) -> DataFrame:
    """Add ``weight`` (share of the raked mixture) to a written table of cells.

    With a budget a cell counts with no more than all its tokens while its margins are scaled; ``weight`` is before that limit.
    The cells carry their targets and factors along, so that a step is one sum and one join, whatever the number of margins:
    the plans and broadcasts of the steps are the driver's to hold.
    """
    total = cells.agg(F.sum("tokens").cast("double")).first()[0] or 1.0
    state = cells
    for m in MARGINS:
        state = state.join(stages.write(targets(cells, m, mix), f"target_{m}"), m)
    state = stages.write(state, "state")
    scaled: list[str] = []  # margins with a factor, in the order of multiplication

    def weighted() -> DataFrame:
        weight = F.col("tokens") / F.lit(total)
        for m in scaled:
            weight = weight * F.col(f"factor_{m}")
        return state.withColumn("weight", weight)

    for _ in range(mix.sweeps):
        for m in MARGINS:
            if mix.budget is None:
                scaled = [x for x in scaled if x != m]
                sums = weighted().groupBy(m).agg(F.sum("weight").alias("now"))
                factor = F.try_divide(f"target_{m}", "now")
            else:
                sums, factor = _limited(weighted(), m, total * mix.budget)
            told = state.drop(f"factor_{m}").join(sums, m).withColumn(f"factor_{m}", F.coalesce(factor, F.lit(0.0)))
            state = stages.write(told.drop(*(c for c in sums.columns if c != m)), "state")
            if m not in scaled:
                scaled = [*scaled, m]
    return weighted().select(*cells.columns, "weight")


def _limited(cells: DataFrame, m: str, kept: float) -> tuple[DataFrame, Column]:
    """Sums by the values of a margin, and the factor that brings what is below its limit to the rest of the target."""
    limit = F.col("tokens") / F.lit(kept)
    old = F.col(f"factor_{m}") if f"factor_{m}" in cells.columns else F.lit(1.0)
    full = F.col("weight") >= limit
    sums = cells.groupBy(m).agg(
        F.max(old).alias("old"), F.sum(F.when(full, limit).otherwise(0.0)).alias("full"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free")
    )
    target = F.col(f"target_{m}")
    to_rest = F.when((F.col("free") > 0) & (target > F.col("full")), (target - F.col("full")) / F.col("free"))
    return sums, F.col("old") * F.coalesce(to_rest, F.try_divide(target, F.col("full") + F.col("free")))


def scale(raked: DataFrame, budget: float) -> float:
    """``c`` for which the sum of min(tokens, c * weight) is ``budget`` times all tokens.

    Each round takes the cells that are full at the last ``c`` as whole and scales the others to the rest,
    which never overshoots, until no further cell gets full.
    """
    tokens, weight = raked.agg(F.sum("tokens"), F.sum("weight")).first()
    if not tokens or not weight or budget >= 1:
        return float("inf")
    c, before = tokens * budget / weight, 0
    while True:
        full = F.col("weight") * F.lit(c) >= F.col("tokens")
        n, whole, free = raked.agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("tokens"))), F.lit(0)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == before or not free:
            return c
        c, before = max(c, (tokens * budget - whole) / free), n


def _decided(docs: DataFrame, mix: Mix, stages: Stages) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``__topic``, ``__tokens``, ``__weight``, ``__probability`` and ``__kept``, and the table of cells."""
    told = described(docs)
    cells = told.groupBy(*(F.col(f"__{m}").alias(m) for m in MARGINS)).agg(
        F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")
    )
    cells = stages.write(cells, "cells")
    raked = stages.write(rake(cells, mix, stages).withColumn("rate", F.col("weight") / F.col("tokens")), "raked")
    weight = F.col("weight")
    if mix.budget is None:
        most = raked.agg(F.max("rate")).first()[0] or 1.0
        probability = F.col("rate") / F.lit(most)
    else:
        kept = (raked.agg(F.sum("tokens")).first()[0] or 1) * min(1.0, mix.budget)
        probability = F.least(F.lit(1.0), F.col("rate") * F.lit(scale(raked, mix.budget)))
        weight = probability * F.col("tokens") / F.lit(float(kept))
    cells = raked.select(*MARGINS, "tokens", weight.alias("weight"), F.round(probability, 9).alias("probability"))
    cells = stages.write(cells, "rates")
    rates = cells.select(
        *(F.col(m).alias(f"__{m}") for m in MARGINS), F.col("weight").alias("__weight"), F.col("probability").alias("__probability")
    )
    out = told.join(rates, [f"__{m}" for m in MARGINS])
    return out.withColumn("__kept", uniform() < F.col("__probability")).drop("__source", "__lang"), cells


def margin_errors(cells: DataFrame, mix: Mix) -> DataFrame:
    """margin, value, target and reached share of the expected tokens, and their difference, from the table of cells."""
    out = None
    for m in MARGINS:
        reached = cells.groupBy(m).agg(F.sum(F.col("tokens") * F.col("probability")).alias("n"))
        total = reached.agg(F.sum("n")).first()[0] or 1.0
        told = targets(cells.select(m, "tokens"), m, mix).join(reached, m).select(
            F.lit(m).alias("margin"), F.col(m).alias("value"), F.col(f"target_{m}").alias("target"), (F.col("n") / F.lit(total)).alias("reached")
        )
        out = told if out is None else out.unionByName(told)
    return out.withColumn("error", F.abs(F.col("reached") - F.col("target")))


RESULTS = ("tokens", "topic", "weight", "probability", "kept")


def calibrated(docs: DataFrame, mix: Mix, stages: Stages) -> DataFrame:
    """Add ``RESULTS`` (weight and probability are those of the cell), named with ``mix_`` in front; columns of these names are replaced."""
    out, _ = _decided(docs.drop(*(f"mix_{c}" for c in RESULTS)), mix, stages)
    return out.withColumnsRenamed({f"__{c}": f"mix_{c}" for c in RESULTS})


def largest_error(docs: DataFrame, mix: Mix, stages: Stages) -> float:
    """The largest difference of a margin's share from its target, in expectation; 0 for an empty table."""
    _, cells = _decided(docs, mix, stages)
    return margin_errors(cells, mix).agg(F.max("error")).first()[0] or 0.0


def sample(docs: DataFrame, mix: Mix, stages: Stages) -> DataFrame:
    """The documents that the mixture keeps, with their own columns."""
    return _decided(docs, mix, stages)[0].where("__kept").select(docs.columns)
