"""Toxicity scores from FTRL-proximal logistic regression.

A text becomes the set of its hashed word n-grams: words, word stems (first four
bytes), pairs of neighbours, and skip-grams (pairs with one or two words left
out). The model is fitted online with the FTRL-proximal rule (McMahan et al.,
2013): each coordinate has its own learning rate, and the L1 term keeps all but
a few thousand weights at zero, so the model is a small broadcast.

Defined results: a null text counts as empty; an empty or wordless text gets the
score of the bias alone; very long texts are read whole; repeated rows get equal
scores; an empty table gives no rows. Labels that are null or belong to no
document are not used; a document labelled twice counts as toxic if one label
says so. Without any label of one of the classes the score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GAPS = (1, 2, 3)  # neighbours, one word between, two words between
_SEPARATORS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


@dataclass(frozen=True)
class Ftrl:
    """Parameters. ``rows_per_class`` bounds the sample of labelled rows the model is fitted on."""

    bits: int = 20
    rows_per_class: int = 3000
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 1.0
    epochs: int = 3
    stem_bytes: int = 4


@dataclass(frozen=True)
class ToxicityModel:
    """Non-zero weights by feature number; ``bias`` is None when there was nothing to learn from."""

    features: np.ndarray
    weights: np.ndarray
    bias: float | None
    params: Ftrl


def features(text: str | None, params: Ftrl) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_SEPARATORS).split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    k = params.stem_bytes
    stems = np.fromiter(map(xxhash.xxh64_intdigest, [w[:k] for w in words]), np.uint64, n)
    parts = [hashed * np.uint64(_MIX[0]), stems * np.uint64(_MIX[1])]
    for gap in _GAPS:
        parts.append((hashed[:-gap] * np.uint64(_MIX[1 + gap])) ^ (hashed[gap:] * np.uint64(_MIX[0])))
    mixed = np.concatenate(parts)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(_MIX[0])
    return np.unique(mixed >> np.uint64(64 - params.bits)).astype(np.int64)


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def train(rows: list[tuple[np.ndarray, int]], params: Ftrl) -> tuple[np.ndarray, float]:
    """FTRL-proximal over the rows in the given order: all weights, and the bias."""
    size = 1 << params.bits
    z, squares = np.zeros(size + 1), np.zeros(size + 1)  # the last coordinate is the bias
    l1 = np.full(size + 1, params.l1)
    l1[size] = 0

    def weights(at):
        zs = z[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1[at], 0)
        return -shrunk / ((params.beta + np.sqrt(squares[at])) / params.alpha + params.l2)

    for _ in range(params.epochs):
        for found, label in rows:
            at = np.append(found, size)
            w = weights(at)
            g = _sigmoid(float(w.sum())) - label
            step = (np.sqrt(squares[at] + g * g) - np.sqrt(squares[at])) / params.alpha
            z[at] += g - step * w
            squares[at] += g * g
    every = weights(np.arange(size + 1))
    return every[:size], float(every[size])


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: "F.Column") -> DataFrame:
    """doc_id and label of the documents that may be learned from."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn)
    known = known.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    return known.join(docs.select("doc_id"), "doc_id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, learn, params: Ftrl = Ftrl(), label: str = "toxic") -> ToxicityModel:
    """Fit on a sample of ``rows_per_class`` documents of each class, in the order of a hash of their ids.

    ``learn`` is a condition on ``labels`` that says which rows may be learned
    from. Only the sample's ids (bounded) are broadcast; its texts go to a
    single task, which is an online learner and sees them in another hash's
    order, so that the classes are mixed. Scores refer to the sample, in which
    the rarer class weighs more than among all rows.
    """
    none = ToxicityModel(np.empty(0, np.int64), np.empty(0), None, params)
    known = labelled(docs, labels, label, learn)
    classes = {r["label"] for r in known.select("label").distinct().collect()}
    if not {0, 1} <= classes:
        return none
    order = F.xxhash64("doc_id")
    picked = [known.where(F.col("label") == y).orderBy(order, "doc_id").limit(params.rows_per_class) for y in (0, 1)]
    sample = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")

    def learner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            texts, ys = batch.column("text").to_pylist(), batch.column("label").to_pylist()
            rows += [(features(t, params), y) for t, y in zip(texts, ys)]
        if rows:
            weights, bias = train(rows, params)
            at = np.flatnonzero(weights)
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": pa.array(np.append(at, -1), pa.int64()),
                    "weight": pa.array(np.append(weights[at], bias), pa.float64()),
                }
            )

    one_task = sample.select("text", "label", F.hash("doc_id", F.lit("order")).alias("at"), "doc_id").repartition(1)
    one_task = one_task.sortWithinPartitions("at", "doc_id", "text").select("text", "label")
    fitted = one_task.mapInArrow(learner, "feature bigint, weight double").toPandas()
    if fitted.empty:
        return none
    is_bias = fitted["feature"] < 0
    bias = float(fitted.loc[is_bias, "weight"].iloc[0])
    kept = fitted[~is_bias]
    return ToxicityModel(kept["feature"].to_numpy(), kept["weight"].to_numpy(), bias, params)


def with_score(docs: DataFrame, model: ToxicityModel, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """Add the score (0 to 1) and ``predicted`` (score >= 0.5) under the given names."""
    if model.bias is None:
        return docs.withColumns({score: F.lit(0.0), predicted: F.lit(0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        dense = np.zeros(1 << m.params.bits)
        dense[m.features] = m.weights
        for batch in texts:
            yield pd.Series([_sigmoid(m.bias + float(dense[features(t, m.params)].sum())) for t in batch], dtype="float64")

    return docs.withColumn(score, scores("text")).withColumn(predicted, (F.col(score) >= 0.5).cast("int"))
