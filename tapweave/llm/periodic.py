"""Periodic runs of words, found with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with a smallest period q (words q apart
are identical) that is at least twice q and ``min_words`` long and can't be
extended. Every word of such a run lies in a window of ``min_words`` / 2 words
that occurs twice in the text, so stretches without repeated windows are passed
over first; what is left is searched.

The suffix links of a stretch's automaton form a tree. Words are appended one by
one; the path from the new prefix's state to the root is recoloured with its end,
as the access of a link-cut tree does: a preferred path holds the states whose
strings were last seen at one end. Where the path passes a piece of an older
end, the distance of both ends is a period if it is not above the piece's
longest string, that is a square ends here. The piece's longest string is what
both ends have in common to the left, so it gives the run's start; words are
compared to the right until the period breaks. Of equal squares of a period the
last end is the nearest one, so every distance found is a smallest period.

Defined results: null texts have no words, texts without words no runs and an
empty collapsed text; very long texts are read whole, in one task each; repeated
rows get equal results; an empty table gives no rows; other columns are passed
through, save one that has the name of the result, which is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Run = tuple[int, int, int]  # start, length, period


@dataclass(frozen=True)
class RunParams:
    min_words: int = 12


class SuffixTree:
    """Suffix links of a sequence: parent and longest string per state, the state of every prefix."""

    def __init__(self, words: list[int]):
        step: list[dict[int, int]] = [{}]
        link, longest, states = [-1], [0], []
        last = 0
        for c in words:
            now = len(longest)
            longest.append(longest[last] + 1)
            step.append({})
            link.append(0)
            p = last
            while p != -1 and c not in step[p]:
                step[p][c] = now
                p = link[p]
            if p != -1:
                q = step[p][c]
                if longest[p] + 1 == longest[q]:
                    link[now] = q
                else:
                    copy = len(longest)
                    longest.append(longest[p] + 1)
                    step.append(step[q].copy())
                    link.append(link[q])
                    while p != -1 and step[p].get(c) == q:
                        step[p][c] = copy
                        p = link[p]
                    link[q] = link[now] = copy
            states.append(now)
            last = now
        self.link, self.longest, self.states = link, longest, states


def squares(words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(end, period, words in common to the left) of squares, by end; ends count from 0.

    Preferred paths are splay trees ordered by depth. All states of one path
    were last seen at the same end, which is kept at the splay tree's root.
    """
    tree = SuffixTree(words)
    longest = tree.longest
    size = len(longest)
    # the place -1 is a dummy, so that links to nothing can be written
    up = tree.link + [-1]
    left, right, seen = [-1] * (size + 1), [-1] * (size + 1), [-1] * (size + 1)
    for end, x in enumerate(tree.states):
        below = -1
        while x != -1:
            # splay x to the root of its preferred path
            p = up[x]
            while p != -1 and (left[p] == x or right[p] == x):
                g = up[p]
                if g != -1 and (left[g] == p or right[g] == p):
                    top = up[g]
                    over = g
                    if left[g] == p:
                        if left[p] == x:
                            b = right[p]
                            left[g] = b
                            up[b] = g
                            right[p] = g
                            up[g] = p
                            b = right[x]
                            left[p] = b
                            up[b] = p
                            right[x] = p
                            up[p] = x
                        else:
                            b = left[x]
                            right[p] = b
                            up[b] = p
                            b = right[x]
                            left[g] = b
                            up[b] = g
                            left[x] = p
                            right[x] = g
                            up[p] = up[g] = x
                    elif right[p] == x:
                        b = left[p]
                        right[g] = b
                        up[b] = g
                        left[p] = g
                        up[g] = p
                        b = left[x]
                        right[p] = b
                        up[b] = p
                        left[x] = p
                        up[p] = x
                    else:
                        b = right[x]
                        left[p] = b
                        up[b] = p
                        b = left[x]
                        right[g] = b
                        up[b] = g
                        right[x] = p
                        left[x] = g
                        up[p] = up[g] = x
                else:
                    top = g
                    over = p
                    if left[p] == x:
                        b = right[x]
                        left[p] = b
                        right[x] = p
                    else:
                        b = left[x]
                        right[p] = b
                        left[x] = p
                    up[b] = p
                    up[p] = x
                up[x] = top
                if left[top] == over:
                    left[top] = x
                elif right[top] == over:
                    right[top] = x
                seen[x] = seen[over]
                p = top
            before = seen[x]
            if before >= 0 and end - before <= longest[x]:
                yield end, end - before, longest[x]
            # what is deeper on the old path keeps the old end
            deeper = right[x]
            seen[deeper] = before
            right[x] = below
            below = x
            x = up[x]
        seen[below] = end


def _runs(words: list[int], least: int) -> list[Run]:
    found, done = [], {}
    n = len(words)
    for end, period, common in squares(words):
        if done.get(period, -1) >= end:
            continue
        start, stop = end - period - common + 1, end + 1
        while stop < n and words[stop] == words[stop - period]:
            stop += 1
        done[period] = stop - 1
        if stop - start >= least:
            found.append((start, stop - start, period))
    return found


def _repeated(ids: np.ndarray, window: int) -> np.ndarray | None:
    """Which words lie in a window that seems to occur twice; None if there is no such window."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    n = len(ids) - window + 1
    hashed = np.zeros(n, np.uint64)
    for k in range(window):
        hashed = hashed * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n]
    order = np.argsort(hashed)
    ordered = hashed[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return None
    twice = np.zeros(n + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    opened = np.zeros(len(ids) + 1, np.int64)
    opened[:n] += twice[:n]
    opened[window : window + n] -= twice[:n]
    return np.cumsum(opened[:-1]) > 0


def stretches(ids: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of the sequence that hold all its runs of at least ``least`` words."""
    todo = [(0, ids)]
    while todo:
        start, part = todo.pop()
        if len(part) < least:
            continue
        covered = _repeated(part, (least + 1) // 2)
        if covered is None:
            continue
        if covered.all():
            yield start, part
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
        todo += [(start + int(a), part[a:b]) for a, b in zip(edges[::2], edges[1::2])]


def find_runs(words: list, params: RunParams = RunParams()) -> list[Run]:
    """All runs of a sequence of hashable words, by start, then period."""
    least = max(2, params.min_words)
    numbers: dict = {}
    ids = [numbers.setdefault(w, len(numbers)) for w in words]
    if len(ids) < least or len(numbers) == len(ids):
        return []
    runs = []
    for start, part in stretches(np.array(ids, np.int64), least):
        runs += [(start + s, length, period) for s, length, period in _runs(part.tolist(), least)]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    opened = [0] * (len(words) + 1)
    for start, length, period in runs:
        opened[start + period] += 1
        opened[start + length] -= 1
    kept, inside = [], 0
    for w, change in zip(words, opened):
        inside += change
        if not inside:
            kept.append(w)
    return kept


FOUND = "runs array<struct<start:long,length:long,period:long>>, collapsed string, n_words long"


def with_runs(
    docs: DataFrame, params: RunParams = RunParams(), into: str = "periodic",
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None, key: str = "doc_id",
) -> DataFrame:
    """Add ``into``: the runs of every text, the text with each run cut to its first period, and the number of words.

    ``rewrite`` may change the words of a row, given its key, before the search.
    """

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for keys, texts in batches:
            rows = []
            for k, text in zip(keys, texts):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                if rewrite is not None:
                    words = rewrite(None if pd.isna(k) else int(k), words)
                runs = find_runs(words, params)
                said = b" ".join(collapsed(words, runs)).decode("utf-8", "replace")
                rows.append(([dict(zip(("start", "length", "period"), r)) for r in runs], said, len(words)))
            yield pd.DataFrame(rows, columns=["runs", "collapsed", "n_words"])

    return docs.withColumn(into, find(key, "text"))


def digested(found: DataFrame, periodic: str = "periodic") -> DataFrame:
    """doc_id, number of runs, the longest run (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    runs = F.col(periodic)["runs"]
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    told = found.select("doc_id", runs.alias("__runs"), best.alias("__best"), F.array_join(lines, "").alias("__lines"), F.col(periodic)["collapsed"].alias("__said"))
    length, period = F.col("__best.length"), -F.col("__best.period")
    return told.select(
        "doc_id", F.size("__runs").cast("long").alias("n_runs"), (-F.col("__best.start")).alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.col("__lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("__said").cast("binary"), 256).alias("collapsed_sha256"),
    )
