"""Exact top-k inner products with multi-resolution segment statistics.

A vector is cut into segments; each is described by its mean and its deviation
(the norm of what is left after the mean). For two vectors these bound the
distance from below, and with the norms the inner product from above:

    distance^2 >= sum over segments of  len * (mean - mean')^2 + (dev - dev')^2

Dimensions are ordered by their energy, so that a segment holds like ones. Levels
go from one segment to many. After each level only pairs whose bound reaches the
query's k-th best score so far go on; the exact product is computed for the
survivors. Scores of components are integers, so results are exact, and bounds
are widened by their rounding error before they may drop a pair. Clustered
vectors are mostly dropped by one segment; vectors without structure, in which no
segment says more than another, only by the finest level.

Queries are dealt to blocks, candidates to parts; a task sees one block and one
part, in Arrow batches, and returns k rows per query; the best k of those are
the result. Work is queries times candidates by definition, but each task's
share has a fixed size.

Defined results: null vectors, empty ones and vectors with null or non-finite
components take no part, nor do rows without an id; vectors of another length than the query's are no
candidates; rows with the query's id are never its candidates; equal scores are
ordered by id; fewer than k candidates give fewer rows; queries
without candidates and empty tables give none. Of queries with one id and
several different vectors each has its own k rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapweave.functions.stage import Stages


@dataclass(frozen=True)
class TopK:
    """``block``: queries a task holds; ``part``: candidates it compares them with."""

    k: int = 20
    scale: int = 64
    block: int = 1024
    part: int = 8192
    chunk: int = 2048
    levels: tuple[int, ...] = (1, 4, 16, 48)


def scaled(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component, or null if the vector takes no part."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("bigint"))
    return F.when(v.isNotNull() & (F.size(v) > 0) & ~bad, whole)


def segment_statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Root-length-weighted mean and deviation of every segment: rows times segments."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    means, devs = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        part = x[:, lo:hi]
        mean = part.mean(axis=1)
        means.append(mean * np.sqrt(hi - lo))
        devs.append(np.sqrt(np.maximum(np.square(part - mean[:, None]).sum(axis=1), 0)))
    return np.stack(means, axis=1), np.stack(devs, axis=1)


def _alive(query_stats, cand_stats, at: slice, floor: np.ndarray, slack: np.ndarray, dropped: np.ndarray) -> np.ndarray:
    """Pairs whose upper bound reaches the floor on every level, coarse to fine; ``dropped`` counts those that a level drops."""
    alive = np.ones(slack.shape, bool)
    for level, ((qm, qd), (cm, cd)) in enumerate(zip(query_stats, cand_stats)):
        columns = np.flatnonzero(alive.any(axis=0))
        rows = np.flatnonzero(alive.any(axis=1))
        if len(columns) == 0:
            break
        # from the distance bound: products of means and of deviations, summed over segments
        upper = qm[rows] @ cm[at][columns].T + qd[rows] @ cd[at][columns].T
        square = np.ix_(rows, columns)
        before = alive[square]
        after = before & (upper + slack[square] >= floor[rows, None])
        dropped[level] += int(before.sum() - after.sum())
        alive[square] = after
    return alive


def _products(q: np.ndarray, c: np.ndarray, r: np.ndarray, j: np.ndarray, size: int = 50_000) -> np.ndarray:
    """Exact products of single pairs, some at a time."""
    out = np.empty(len(r), q.dtype)
    for lo in range(0, len(r), size):
        part = slice(lo, lo + size)
        out[part] = np.einsum("ij,ij->i", q[r[part]], c[j[part]])
    return out


def search(
    queries: np.ndarray, query_ids: np.ndarray, cands: np.ndarray, ids: np.ndarray, params: TopK, dropped: np.ndarray | None = None
):
    """Row of the query, id and score of the best k candidates of every query.

    Dimensions are ordered by their energy, so that segments hold like ones, and
    candidates by their norm, so that high scores and with them high floors come
    early. Where few pairs of a chunk survive, only their products are computed.
    ``dropped`` (one place a level) is added up with the pairs that each level drops.
    """
    dropped = np.zeros(len(params.levels), np.int64) if dropped is None else dropped
    n, k = len(queries), params.k
    energy = np.argsort(-np.square(cands.astype(np.float64)).sum(axis=0), kind="stable")
    by_norm = np.argsort(-np.square(cands.astype(np.float64)).sum(axis=1), kind="stable")
    queries, cands, ids = queries[:, energy], cands[by_norm][:, energy], ids[by_norm]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(cands).max(initial=0)) * queries.shape[1]
    kind = np.float64 if largest < 1 << 52 else np.int64  # sums of whole numbers are exact either way
    low = kind(-(1 << 62))
    q, c = queries.astype(kind), cands.astype(kind)
    qf, cf = queries.astype(np.float64), cands.astype(np.float64)
    q_norm, c_norm = np.square(qf).sum(axis=1), np.square(cf).sum(axis=1)
    q_stats = [segment_statistics(qf, s) for s in params.levels]
    c_stats = [segment_statistics(cf, s) for s in params.levels]
    rows, best, score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, kind)
    floor = np.full(n, low)
    lo, size = 0, max(k + 1, params.chunk // 8)
    while lo < len(c):
        at = slice(lo, lo + size)
        lo, size = lo + size, min(2 * size, params.chunk)
        slack = 1e-9 * (q_norm[:, None] + c_norm[None, at] + 1)
        alive = _alive(q_stats, c_stats, at, floor.astype(np.float64), slack, dropped)
        alive &= query_ids[:, None] != ids[None, at]
        columns = np.flatnonzero(alive.any(axis=0))
        if len(columns) == 0:
            continue
        if alive.sum() * 5 < n * len(columns):
            r, j = np.nonzero(alive)
            found = _products(q, c[at], r, j)
            good = found >= floor[r]
            r, j, found = r[good], j[good], found[good]
        else:
            square = np.where(alive[:, columns], q @ c[at][columns].T, low)
            least = floor
            if len(columns) > k:
                least = np.maximum(floor, np.partition(square, len(columns) - k, axis=1)[:, len(columns) - k])
            r, place = np.nonzero((square >= least[:, None]) & (square > low))
            j, found = columns[place], square[r, place]
        rows = np.concatenate([rows, r])
        best = np.concatenate([best, ids[at][j]])
        score = np.concatenate([score, found])
        order = np.lexsort((best, -score, rows))
        rows, best, score = rows[order], best[order], score[order]
        start = np.searchsorted(rows, np.arange(n))
        keep = np.arange(len(rows)) - start[rows] < k
        rows, best, score = rows[keep], best[keep], score[keep]
        last = np.searchsorted(rows, np.arange(n), "right") - 1
        full = np.bincount(rows, minlength=n) == k
        floor = np.where(full, score[np.maximum(last, 0)], low)
    return rows, best, score


def _dealt(df: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Add ``name``, a number from 0 to n - 1 dealt by hash so that about ``size`` rows share it."""
    n = max(1, -(-df.count() // size))
    return df.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")), n


def nearest(
    vectors: DataFrame, is_query: Column, stages: Stages, params: TopK = TopK(), id_name: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of every query row."""
    taking_part = vectors.select(
        F.col(id_name).cast("bigint").alias("vec_id"), scaled(vector, params.scale).alias("v"), is_query.alias("is_query")
    ).where("v IS NOT NULL AND vec_id IS NOT NULL")
    rows = stages.write(taking_part.withColumn("dim", F.size("v")), "vectors")
    queries, blocks = _dealt(rows.where("is_query").select("vec_id", "v", "dim").distinct(), params.block, "block")
    cands, parts = _dealt(rows.select("vec_id", "v", "dim"), params.part, "part")
    # every block meets every part once
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    cands = cands.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "block", "part"]

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []}).astype("int64")
        ids = q["vec_id"].to_numpy(np.int64)
        r, found, score = search(np.stack(q["v"].to_numpy()), ids, np.stack(c["v"].to_numpy()), c["vec_id"].to_numpy(np.int64), params)
        names = q["name"].to_numpy(np.int64)
        return pd.DataFrame({"query_id": ids[r], "query": names[r], "vec_id": found, "score": score.astype(np.int64)})

    named = queries.withColumn("name", F.xxhash64("vec_id", "v"))  # tells vectors of one id apart
    met = named.groupBy(*keys).cogroup(cands.groupBy(*keys)).applyInPandas(
        best, "query_id bigint, query bigint, vec_id bigint, score bigint"
    )
    by_score = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= params.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
