"""Quality rules: counted rules, then a calibrated n-gram classifier with fixed thresholds.

Counted rules come first: too few words, or too many words in windows that the
text repeats. What passes them is judged by a logistic regression over hashed
n-grams: single words and pairs of neighbours, and pairs and triples of
characters (code points). A word equal to the one before it counts as the same
mark whatever it is, so that repetition is one feature. The value of a feature is its
share of the text's n-grams of its sort, so a long text is no surer than a short
one. Weights are learned by gradient steps of their own rate per weight
(AdaGrad) on a bounded sample of labelled rows; a further part of the sample,
weighted to the classes' shares among all labelled rows, fits the line that turns
the raw score into a probability. Texts are scored in Arrow batches, and a text is
kept from ``keep_at`` on.

Defined results: a null text counts as empty; texts without words fail the
counted rules and get the score of the bias alone; very long texts are read
whole; repeated rows get equal results; an empty table gives no rows; other
columns are passed through, save one that has the name of the result, which is
replaced. Labels that are null or belong to no document are not used; of several
labels of one id the smallest counts, of several texts of one id the smallest. If
the labels hold one class only, or none, every score is 1 and the counted rules
decide alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SAME = 0x5A4D  # stands for a word equal to the one before it
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class RuleLimits:
    """Thresholds and sizes. ``rows_per_class`` bounds the labelled sample; a fifth of it calibrates."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    keep_at: float = 0.5
    bits: int = 18
    rows_per_class: int = 4000
    epochs: int = 6
    rate: float = 2.0
    l2: float = 1e-5
    calibrating: int = 5


@dataclass(frozen=True)
class RowModel:
    """``weights`` by feature number; probability = sigmoid(slope * raw + shift). Without weights every score is 1."""

    weights: np.ndarray | None
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0


# ------------------------------------------------------------------ features


def _mix(x: np.ndarray, bits: int) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= _MULTIPLIERS[0]
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def ngrams(text: str, words: list[bytes], bits: int) -> list[np.ndarray]:
    """Feature numbers of the words' and the characters' n-grams, one array a sort, with repeats."""
    half = bits - 1  # words and characters have a half of the features each
    out = []
    if words:
        hashed = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        told = hashed.copy()
        told[1:][hashed[1:] == hashed[:-1]] = _SAME
        out.append(_mix(told * _MULTIPLIERS[0], half))
        if len(words) > 1:
            out.append(_mix(told[:-1] * _MULTIPLIERS[1] ^ told[1:] * _MULTIPLIERS[2], half))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(points) > 1:
        pairs = points[:-1] * _MULTIPLIERS[1] ^ points[1:] * _MULTIPLIERS[2]
        chars = [_mix(pairs.copy(), half)]
        if len(points) > 2:
            chars.append(_mix(pairs[:-1] * _MULTIPLIERS[1] ^ points[2:] * _MULTIPLIERS[0], half))
        out += [c + (1 << half) for c in chars]
    return out


def shares(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of a text and their values."""
    text = text or ""
    parts = ngrams(text, text.encode("utf-8", "surrogatepass").split(), bits)
    if not parts:
        return np.empty(0, np.int64), np.empty(0)
    at, of = np.unique(np.concatenate(parts), return_inverse=True)
    values = np.bincount(of, np.concatenate([np.full(len(p), 1 / len(p)) for p in parts]), len(at))
    return at, values


# ------------------------------------------------------------------ counted rules


def repeated_words(words: list[bytes], window: int) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    mixed = ids.astype(np.uint64) * _MULTIPLIERS[0]
    mixed ^= mixed >> np.uint64(29)
    hashed = np.zeros(n, np.uint64)
    for k in range(window):
        hashed = hashed * _MULTIPLIERS[1] + mixed[k : k + n]
    ordered = np.sort(hashed)
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    # equal hashes propose, the words themselves decide
    suspects = np.flatnonzero(np.isin(hashed, ordered[1:][same]))
    grams = ids[suspects[:, None] + np.arange(window)]
    _, of, times = np.unique(grams, axis=0, return_inverse=True, return_counts=True)
    twice = suspects[times[of.ravel()] > 1]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, twice, 1)
    np.add.at(change, twice + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def counts(text: str, words: list[bytes], window: int) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    blanks = sum(map(text.count, " \t\n\r\x0b\x0c"))
    return len(words), len(text) - blanks, sum(map(text.count, _SYMBOLS)), repeated_lines(text), repeated_words(words, window)


# ------------------------------------------------------------------ learning


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def learn(rows: list[tuple[np.ndarray, np.ndarray, int]], limits: RuleLimits) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic regression, rows in the given order."""
    size = 1 << limits.bits
    w, squares = np.zeros(size), np.full(size, 1e-6)
    bias, bias_squares = 0.0, 1e-6
    for _ in range(limits.epochs):
        for at, x, y in rows:
            error = sigmoid(bias + float(w[at] @ x)) - y
            g = error * x + limits.l2 * w[at]
            squares[at] += g * g
            w[at] -= limits.rate * g / np.sqrt(squares[at])
            bias_squares += error * error
            bias -= 0.1 * error / math.sqrt(bias_squares)
    return w, bias


def calibrate(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the line whose sigmoid fits the weighted labels best; labels are smoothed by one row each way (Platt)."""
    ones = labels == 1
    if not ones.any() or ones.all():
        return 1.0, 0.0
    n1, n0 = ones.sum(), (~ones).sum()
    target = np.where(ones, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([raw, np.ones(len(raw))], 1)
    line = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -35, 35)))
        slope = x.T @ (weights * (p - target)) + 1e-6 * line
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        step *= min(1.0, 2.0 / (1e-12 + np.abs(step).max()))
        line = line - step
        if np.abs(step).max() < 1e-9:
            break
    return (float(line[0]), float(line[1])) if line[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, limits: RuleLimits = RuleLimits(), label: str = "quality") -> RowModel:
    """Fit on ``rows_per_class`` labelled documents of each class, in the order of a hash of their ids.

    ``allowed`` is a condition on ``labels`` that says which rows may be learned
    from. Features are made where the sampled texts are, of one text an id; the
    single task of the learner gets at most 2 x ``rows_per_class`` rows of at most
    2 ** ``bits`` features.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & allowed)
    known = known.groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))
    known = known.where(F.col("label").isin(0, 1)).join(docs.select("doc_id"), "doc_id", "left_semi")
    classes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        return RowModel(None)
    picked = [
        known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limits.rows_per_class) for y in (0, 1)
    ]
    sample = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id")
    sample = sample.groupBy("doc_id", "label").agg(F.min("text").alias("text"))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shares(t, limits.bits) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("turn"), batch.column("label"), pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64()))],
                names=["turn", "label", "features", "shares"],
            )

    prepared = sample.select(F.xxhash64("doc_id", F.lit("order")).alias("turn"), "label", "text").mapInArrow(
        featured, "turn bigint, label int, features array<bigint>, shares array<double>"
    )
    total = {y: classes[y] / min(classes[y], limits.rows_per_class) for y in classes}

    def learner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for at, x, y in zip(batch.column("features"), batch.column("shares"), batch.column("label").to_pylist()):
                rows.append((at.values.to_numpy(), x.values.to_numpy(), y))
        if not rows:
            return
        held = rows[:: limits.calibrating]
        learned = [r for i, r in enumerate(rows) if i % limits.calibrating]
        w, bias = learn(learned or held, limits)
        raw = np.array([bias + float(w[at] @ x) for at, x, _ in held])
        ys = np.array([y for _, _, y in held])
        slope, shift = calibrate(raw, ys, np.array([total[y] for y in ys.tolist()]))
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_pydict(
            {"feature": pa.array(np.append(used, [-1, -2, -3]), pa.int64()), "weight": pa.array(np.append(w[used], [bias, slope, shift]))}
        )

    fitted = prepared.repartition(1).sortWithinPartitions("turn", "label").mapInArrow(learner, "feature bigint, weight double").toPandas()
    if fitted.empty:
        return RowModel(None)
    values = dict(zip(fitted["feature"], fitted["weight"]))
    weights = np.zeros(1 << limits.bits)
    used = fitted["feature"] >= 0
    weights[fitted.loc[used, "feature"].to_numpy()] = fitted.loc[used, "weight"].to_numpy()
    return RowModel(weights, values[-1], values[-2], values[-3])


# ------------------------------------------------------------------ judging

JUDGED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"


def with_verdict(docs: DataFrame, model: RowModel, limits: RuleLimits = RuleLimits(), into: str = "quality_rules") -> DataFrame:
    """Add ``into``: the counts, ``base_failed``, the calibrated score and ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(JUDGED)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            rows = []
            for text in texts:
                text = text or ""
                words = text.encode("utf-8", "surrogatepass").split()
                told = counts(text, words, limits.window)
                failed = told[0] < limits.min_words or 100 * told[4] > limits.max_repeat_percent * told[0]
                score = 1.0
                if m.weights is not None:
                    raw = m.bias + sum(float(m.weights[at].mean()) for at in ngrams(text, words, limits.bits))
                    score = sigmoid(m.slope * raw + m.shift)
                rows.append((*told, failed, score, not failed and score >= limits.keep_at))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in JUDGED.split(", ")])

    return docs.withColumn(into, judge("text"))
