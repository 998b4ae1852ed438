"""Packing token sequences by patterns fitted with non-negative least squares.

1. Documents are tokenised and cut: one longer than the sequence becomes pieces
   of full size, the first one takes the remainder. Each task numbers its pieces
   of every length.
2. The histogram of lengths (at most ``size`` numbers) goes to the driver.
   Patterns of one to three lengths that fill a sequence exactly are enumerated,
   their repeat counts fitted to the histogram by non-negative least squares
   (Krell et al., 2021), rounded down and cut to what is there.
3. What is left is packed best-fit, longest first, on the histogram: a sequence
   is filled with the longest piece that still fits, again and again, and the
   pattern so found is repeated as often as its pieces last.
4. Every pattern is a range of sequences and takes ranges of piece numbers; the
   table of ranges (bounded by the number of lengths, not of documents) is
   broadcast, and a piece finds its sequence by binary search.

No piece is compared with another, so hot lengths cost nothing.

Defined results: a null text counts as empty; an empty text is the end token
alone; very long texts are read whole; repeated rows are packed each; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import bisect
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapweave.functions.stage import Stages


@dataclass(frozen=True)
class PackParams:
    """``vocabulary``: path of the tokenizer file, ``ranks``: path of the same vocabulary as ranks, which is
    faster for single words (both None: the public byte-level one); ``end``: id after each document;
    ``words_kept``: words whose ids a Python worker remembers."""

    size: int = 1024
    vocabulary: str | None = None
    ranks: str | None = None
    end: int = 2
    words_kept: int = 300_000
    sparse: int = 900


# Texts of these characters, without blanks next to other white space, can be
# tokenised blank by blank: no token of the vocabulary's pattern spans a word's
# leading blank.
_PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7eÀ-ÖØ-öø-ɏ]*")
_OTHER_SPACE = "\t\n\v\f\r"  # all other white space among these characters


def _blanks_touch(text: str) -> bool:
    """True when a plain text has a blank next to other white space."""
    return "  " in text or any(c in text and (" " + c in text or c + " " in text) for c in _OTHER_SPACE)


# Fixed value: the vocabulary's pattern.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Known(dict):
    """Ids of words; those not there are made, and kept while there is room."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word: str) -> bytes:
        ids = self.make(word)
        if len(self) < self.most:
            self[word] = ids
        return ids


class Encoder:
    """Ids of whole texts as little-endian 32-bit numbers; remembers the ids of words."""

    def __init__(self, params: PackParams):
        import tiktoken
        from tokenizers import Tokenizer

        path, ranks = params.vocabulary, params.ranks
        if path is None:
            import public_tokenizers

            path, ranks = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a few texts start with the same word, so few of these are worth keeping
        self.first = _Known(self._ids, params.words_kept // 10)
        self.inner = _Known(lambda word: self._word(" " + word), params.words_kept)
        self.single = None
        if ranks is not None:
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.single = tiktoken.Encoding("words", pat_str=_PATTERN, mergeable_ranks=table, special_tokens={})

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if self.single is None:
            return self._ids(word)
        ids = self.single.encode_ordinary(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or _blanks_touch(text) or any(s in text for s in self.specials):
            return self._ids(text)
        first, *words = text.split(" ")
        return self.first[first] + b"".join(map(self.inner.__getitem__, words))


_ENCODERS: dict[PackParams, Encoder] = {}  # of this Python worker


def encoder(params: PackParams) -> Encoder:
    if params not in _ENCODERS:
        _ENCODERS[params] = Encoder(params)
    return _ENCODERS[params]


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """Start and length of the pieces: all full but the first."""
    first = length % size or size
    return [(0, first), *((at, size) for at in range(first, length, size))] if length > size else [(0, length)]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, chunk int, number bigint"


def pieces(docs: DataFrame, params: PackParams = PackParams()) -> DataFrame:
    """One row per piece; ``number`` counts the pieces of a length within a task (``chunk``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(params)
        end = np.array([params.end], "<u4").tobytes()
        chunk, seen = TaskContext.get().partitionId(), [0] * (params.size + 1)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py() or "") + end
                for i, (at, n) in enumerate(cut(len(ids) // 4, params.size)):
                    out.append((doc, i, at, n, zlib.crc32(ids[4 * at : 4 * (at + n)]), chunk, seen[n]))
                    seen[n] += 1
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "chunk", "number"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def enumerate_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """Patterns of one to three of the given lengths that sum to ``size``; rows are padded with 0."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    out = [(size, 0, 0)] if there[size] else []
    out += [(size - b, b, 0) for b in range(1, size // 2 + 1) if there[b] and there[size - b]]
    for c in range(1, size // 3 + 1):
        if there[c]:
            b = np.arange(c, (size - c) // 2 + 1)
            b = b[there[b] & there[size - c - b]]
            out += [(size - c - x, x, c) for x in b.tolist()]
    return np.array(out, np.int64).reshape(-1, 3)


def nnls(patterns: np.ndarray, histogram: np.ndarray, most: int, add: int = 40, rounds: int = 80) -> np.ndarray:
    """Repeat counts x >= 0 that make the patterns' lengths fit the histogram in the least-squares sense.

    Active sets: patterns whose gradient is largest enter in groups, those whose
    count turns negative leave; at most ``most`` are in use, so few counts are
    small.
    """
    n, size = len(patterns), len(histogram)
    x = np.zeros(n)

    def gradient() -> np.ndarray:
        left = histogram - np.bincount(patterns.ravel(), np.repeat(x, 3), size)
        left[0] = 0
        return left[patterns].sum(axis=1)

    active = np.zeros(n, bool)
    for _ in range(rounds):
        g = gradient()
        g[active] = 0
        room = min(add, most - int(active.sum()))
        best = np.argsort(-g, kind="stable")[: max(0, room)]
        best = best[g[best] > 1e-6 * (histogram.max() + 1)]
        if len(best) == 0:
            break
        active[best] = True
        while active.any():
            at = np.flatnonzero(active)
            a = np.zeros((size, len(at)))
            np.add.at(a, (patterns[at].ravel(), np.repeat(np.arange(len(at)), 3)), 1.0)
            a[0] = 0
            solved = np.linalg.solve(a.T @ a + 1e-6 * np.eye(len(at)), a.T @ histogram)
            if (solved > 0).all():
                x[:] = 0
                x[at] = solved
                break
            down = solved <= 0
            old = x[at]
            step = np.min(np.where(down, old / np.maximum(old - solved, 1e-12), 1.0))
            x[at] = np.maximum(old + step * (solved - old), 0)
            gone = at[down & (x[at] <= 1e-9)]
            active[gone if len(gone) else at[down]] = False
            x[~active] = 0
    return x


def plan(counts: dict[int, int], size: int, params: PackParams = PackParams()) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns as lists of (length, times), longest first, with their number of repeats; uses up the histogram."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    if left.pop(size, 0):
        out.append(([(size, 1)], counts[size]))
    if left:
        patterns = enumerate_patterns(np.array(sorted(left)), size)
        histogram = np.zeros(size + 1)
        for n, c in left.items():
            histogram[n] = c
        fitted = nnls(patterns, histogram, params.sparse) if len(patterns) else np.empty(0)
        for i in np.argsort(-fitted, kind="stable"):
            if fitted[i] < 1:
                break
            used = [(int(n), int(t)) for n, t in zip(*np.unique(patterns[i][patterns[i] > 0], return_counts=True))][::-1]
            times = min(int(fitted[i]), *(left.get(n, 0) // t for n, t in used))
            if times > 0:
                out.append((used, times))
                for n, t in used:
                    left[n] -= t * times
    order = sorted(n for n, c in left.items() if c > 0)
    while order:
        gap, used = size, []
        taken: dict[int, int] = {}
        while order:
            i = bisect.bisect_right(order, gap) - 1
            while i >= 0 and left[order[i]] == taken.get(order[i], 0):
                i -= 1
            if i < 0:
                break
            n = order[i]
            fit = min(gap // n, left[n] - taken.get(n, 0))
            taken[n] = taken.get(n, 0) + fit
            used.append((n, fit))
            gap -= n * fit
        times = min(left[n] // t for n, t in used)
        out.append((used, times))
        for n, t in used:
            left[n] -= t * times
            if left[n] == 0:
                order.remove(n)
    return out


def slots(planned: list[tuple[list[tuple[int, int]], int]]) -> dict[int, np.ndarray]:
    """By length: rows (first number, times in a sequence, first sequence, offset), ordered by first number."""
    used: dict[int, int] = {}
    out: dict[int, list] = {}
    sequence = 0
    for pattern, repeats in planned:
        offset = 0
        for n, times in pattern:
            first = used.get(n, 0)
            out.setdefault(n, []).append((first, times, sequence, offset))
            used[n] = first + times * repeats
            offset += n * times
        sequence += repeats
    return {n: np.array(rows, np.int64) for n, rows in out.items()}


def pack(docs: DataFrame, stages: Stages, params: PackParams = PackParams()) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    rows = stages.write(pieces(docs, params), "pieces")
    counted = stages.write(rows.groupBy("length", "chunk").agg(F.count(F.lit(1)).alias("n")), "counted")
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most ``size`` rows
    table = slots(plan({int(r["length"]): int(r["n"]) for r in histogram}, params.size, params))
    shared = docs.sparkSession.sparkContext.broadcast(table)
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        size, number = lengths.to_numpy(), numbers.to_numpy()
        for n in np.unique(size):
            at = np.flatnonzero(size == n)
            found = shared.value[int(n)]
            row = found[np.searchsorted(found[:, 0], number[at], "right") - 1]
            along = number[at] - row[:, 0]
            sequence[at] = row[:, 2] + along // row[:, 1]
            offset[at] = row[:, 3] + along % row[:, 1] * n
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = rows.join(first, ["length", "chunk"])
    placed = placed.withColumn("place", place("length", F.col("first") + F.col("number")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
