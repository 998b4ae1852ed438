"""The trie of conversation prefixes, by truncation peeling.

Every turn becomes 128 bits of the SHA-256 of its role and text, so a
conversation is a short path and texts are read once and never shuffled. Paths
are dealt over the tasks in sorted order, so the members of a node are neighbours.
A task peels its paths from the greatest depth: conversations that end at the
present depth join the nodes that survived from below, the group's sums are the
node's, then the last turn is stripped and the survivors are grouped again. Nodes
and their sums come out of the same pass, at one sort and no round per level.

Only the prefixes of a task's first and last path may have members in other
tasks. What a task has of them is one row per path (numbers by depth), and those
rows, two per task, are peeled in the same way in far fewer tasks, until one has
them all. So a node that holds a third of all conversations, and a conversation
copied any number of times, are divided like other rows.

Defined results: rows without a conversation id belong to no conversation and
are left out; a null turn comes first, equal turns are ordered by their digest,
null roles and texts are empty; repeated rows are turns of their own; an empty
table gives no nodes; other columns are not read, whatever their names. A path
takes 24 bytes a turn and is one row: a conversation of a million turns is 24 MB.
The digest of the ids that end at a node is by definition computed in order, so
the ids of one node are read by one task, block by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages

_GREATEST = np.iinfo(np.int64).max
_TURN = 16  # bytes of a turn in a path
_NOTHING = hashlib.sha256(b"").hexdigest()
_SUMS = ("n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens")
NODE_COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@dataclass(frozen=True)
class TrieParams:
    """``turns``: turns per task; ``open_paths``: border paths per task; ``ids``: ids per block of ends."""

    turns: int = 100_000
    open_paths: int = 50_000
    ids: int = 8192


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id and ``turns``, the ordered array of (digest, words)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        "turn",
        F.substring(F.sha2(named.cast("binary"), 256), 1, 2 * _TURN).alias("digest"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"),
    )
    told = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("t"))
    ordered = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words")))
    return told.groupBy("conv_id").agg(ordered.alias("turns"))


def with_shared_heads(told: DataFrame, family: int, taken: Column) -> DataFrame:
    """Every conversation c starts with the first ``taken`` turns of c - c % ``family`` in place of as many of its own."""
    longest = told.select(F.col("conv_id").alias("__base"), F.slice("turns", 1, 3).alias("__head")).where(F.col("__base") % family == 0)
    joined = told.withColumns({"__base": F.col("conv_id") - F.col("conv_id") % family, "__taken": taken.cast("int")}).join(longest, "__base", "left")
    none = F.array().cast(told.schema["turns"].dataType)
    head = F.slice(F.coalesce("__head", none), F.lit(1), F.col("__taken"))
    own = F.slice("turns", F.col("__taken") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


# ------------------------------------------------------------------ peeling

_LONG = pa.int64()
_EVENT = pa.struct([("depth", _LONG), *((name, _LONG) for name in _SUMS)])
_OUT = pa.schema(
    [
        ("kind", pa.int32()), ("depth", _LONG), ("parent_conv_id", _LONG), *((name, _LONG) for name in _SUMS),
        ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()),
        ("path", pa.binary()), ("words", pa.list_(_LONG)), ("events", pa.list_(_EVENT)), ("ids", pa.string()),
    ]
)
_DDL = (
    "kind int, depth long, parent_conv_id long, " + ", ".join(f"{name} long" for name in _SUMS)
    + ", ends_sha256 string, key binary, parent_key binary, path binary, words array<long>, "
    "events array<struct<depth:long, " + ", ".join(f"{name}:long" for name in _SUMS) + ">>, ids string"
)
_NODE, _OPEN, _ENDS = 0, 1, 2


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.sha256(path[: _TURN * depth]).digest()[:_TURN]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share from the start."""
    if b.startswith(a):
        return len(a) // _TURN
    k = 0
    while a[k : k + _TURN] == b[k : k + _TURN]:
        k += _TURN
    return k // _TURN


def _batch(kind: int, columns: dict) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    columns = {"kind": np.full(size, kind, np.int32), **columns}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _OUT], schema=_OUT
    )


class _Peel:
    """Sorted paths of one task, peeled level by level.

    ``events`` are sums known at (row, depth): a conversation has one, at its
    end. ``closed`` says that no other task has members of these paths' nodes.
    """

    def __init__(self, rows: list[bytes], words: list[np.ndarray], events: np.ndarray, at: np.ndarray, ended: bool, closed: bool, ids: int):
        self.rows, self.words, self.ended, self.closed, self.ids = rows, words, ended, closed, ids
        order = np.lexsort((at, -events[:, 0]))
        self.events, self.at = events[order], at[order]
        n = len(rows)
        self.shared = np.fromiter((-1 if i == 0 else _common(rows[i - 1], rows[i]) for i in range(n)), np.int64, n)
        # turns shared with the first and the last row
        first = np.append(len(rows[0]) // _TURN, self.shared[1:])
        last = np.append(self.shared[1:], len(rows[-1]) // _TURN)
        self.with_first = np.minimum.accumulate(first)
        self.with_last = np.minimum.accumulate(last[::-1])[::-1]

    def _ends(self, begins: np.ndarray, stops: np.ndarray, ids: np.ndarray) -> list[str]:
        return [
            hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest() if a < b else _NOTHING
            for a, b in zip(begins.tolist(), stops.tolist())
        ]

    def run(self) -> Iterator[pa.RecordBatch]:
        left: dict[int, list[tuple]] = {0: [], len(self.rows) - 1: []}
        rows, was_open = np.empty(0, np.int64), np.empty(0, bool)
        sums = np.empty((0, len(_SUMS)), np.int64)
        digests: list[str] = []
        spent = 0
        deepest = int(self.events[0, 0])
        for depth in range(deepest, -1, -1):
            stop = spent + int(np.searchsorted(-self.events[spent:, 0], -depth, "right"))
            now, now_at = self.events[spent:stop, 1:], self.at[spent:stop]
            spent = stop
            # survivors from below and what is newly known at this depth, in the order of rows
            child = sums.copy()
            child[:, 2] = 1
            child[was_open] = (0, _GREATEST, 0, 0, 0)  # only keeps the place, its sums are passed on
            every = np.concatenate([now, child])
            where = np.concatenate([now_at, rows])
            order = np.argsort(where, kind="stable")
            every, placed = every[order], where[order]
            fresh = self.shared[placed] < depth
            fresh[1:] &= placed[1:] != placed[:-1]
            starts = np.flatnonzero(fresh)
            group = np.empty(len(order), np.int64)
            group[order] = np.cumsum(fresh) - 1
            heads = placed[starts]
            total = np.add.reduceat(every, starts, axis=0)
            total[:, 1] = np.minimum.reduceat(every[:, 1], starts)
            if self.closed:
                is_open = np.zeros(len(starts), bool)
            else:
                is_open = (self.with_first[heads] >= depth) | (self.with_last[heads] >= depth)
            keys = {int(g): _key(self.rows[heads[g]], depth) for g in np.flatnonzero(is_open)}

            if len(rows):  # the nodes one deeper have got their parents
                done = ~was_open
                parents = group[len(now) :][done]
                yield self._nodes(
                    depth + 1, rows[done], sums[done], digests, total[parents, 1], is_open[parents], [keys.get(g) for g in parents.tolist()]
                )
            digests = []
            if self.ended:
                of = group[: len(now)]
                begins, stops = np.searchsorted(of, np.arange(len(starts))), np.searchsorted(of, np.arange(len(starts)), "right")
                closed = ~is_open
                digests = self._ends(begins[closed], stops[closed], now[:, 1])
                for g, key in keys.items():
                    yield from self._blocks(key, now[begins[g] : stops[g], 1])
            for g in keys:
                owner = 0 if self.with_first[heads[g]] >= depth else len(self.rows) - 1
                left[owner].append((depth, *total[g].tolist()))
            rows, sums, was_open = heads, total, is_open
            sums[:, 3] += sums[:, 2] == 0
            if depth:
                sums[:, 4] += (sums[:, 0] - 1) * np.fromiter((self.words[r][depth - 1] for r in rows.tolist()), np.int64, len(rows))
        if self.closed:
            yield self._nodes(0, rows, sums, digests, np.zeros(1, np.int64), np.ones(1, bool), [None])
        kept = [r for r, found in left.items() if found]
        if kept:
            yield _batch(
                _OPEN,
                {
                    "path": [self.rows[r] for r in kept], "words": [self.words[r].tolist() for r in kept],
                    "events": [[dict(zip(("depth", *_SUMS), e)) for e in left[r]] for r in kept],
                },
            )

    def _nodes(self, depth, rows, sums, digests, parents, parent_open, parent_keys) -> pa.RecordBatch:
        columns = {"depth": np.full(len(rows), depth, np.int64), **{name: sums[:, i].copy() for i, name in enumerate(_SUMS)}}
        columns["parent_conv_id"] = pa.array(parents, _LONG, mask=parent_open)
        columns["parent_key"] = parent_keys
        if self.ended:
            columns["ends_sha256"] = digests
        else:
            columns["key"] = [_key(self.rows[r], depth) for r in rows.tolist()]
        return _batch(_NODE, columns)

    def _blocks(self, key: bytes, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(ids), self.ids):
            block = ids[k : k + self.ids].tolist()
            yield _batch(_ENDS, {"key": [key], "conv_id": block[:1], "ids": [",".join(map(str, block))]})


def _words(column: pa.Array) -> list[np.ndarray]:
    flat, at = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.value_lengths().to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(at)[:-1])


def _peel_conversations(closed: bool, ids: int):
    def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, words, convs = [], [], []
        for batch in batches:
            if batch.num_rows:
                rows += batch.column("path").to_pylist()
                words += _words(batch.column("words"))
                convs.append(batch.column("conv_id").to_numpy())
        if rows:
            n = len(rows)
            events = np.zeros((n, 1 + len(_SUMS)), np.int64)
            events[:, 0] = [len(r) // _TURN for r in rows]
            events[:, 1] = 1
            events[:, 2] = np.concatenate(convs)
            yield from _Peel(rows, words, events, np.arange(n), True, closed, ids).run()

    return peel


def _peel_open(closed: bool):
    def peel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, words, events, at = [], [], [], []
        for batch in batches:
            if batch.num_rows:
                known = batch.column("events").to_pylist()
                at += [len(rows) + i for i, e in enumerate(known) for _ in e]
                events += [[e["depth"], *(e[name] for name in _SUMS)] for es in known for e in es]
                rows += batch.column("path").to_pylist()
                words += _words(batch.column("words"))
        if rows:
            yield from _Peel(rows, words, np.array(events, np.int64), np.array(at), False, closed, 1).run()

    return peel


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key; rows come sorted by key and first id."""
    key, digest = None, None
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends": [digest.hexdigest()]})
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
    if key is not None:
        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.binary()), "ends": [digest.hexdigest()]})


def nodes(told: DataFrame, stages: Stages, params: TrieParams = TrieParams()) -> DataFrame:
    """One row per node of the trie of ``told`` (conv_id, turns), with ``NODE_COLUMNS``."""
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    rows = stages.write(told.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words")), "paths")
    size = rows.agg(F.coalesce(F.sum(F.size("words") + 1), F.lit(0))).first()[0]
    tasks = max(1, -(-size // params.turns))
    dealt = rows.repartitionByRange(tasks, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    found = stages.write(dealt.mapInArrow(_peel_conversations(tasks == 1, params.ids), _DDL), "peeled", "kind")
    done = [found.where(F.col("kind") == _NODE)]
    if tasks == 1:
        return done[0].select(*NODE_COLUMNS)

    blocks = found.where(F.col("kind") == _ENDS).select("key", "conv_id", "ids")
    ends = blocks.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ids").mapInArrow(_digests, "key binary, ends string")
    while tasks > 1:
        borders = found.where(F.col("kind") == _OPEN).select("path", "words", "events")
        tasks = max(1, -(-borders.count() // params.open_paths))
        dealt = borders.repartitionByRange(tasks, "path").sortWithinPartitions("path")
        found = stages.write(dealt.mapInArrow(_peel_open(tasks == 1), _DDL), "peeled", "kind")
        done.append(found.where(F.col("kind") == _NODE))

    inner, upper = done[0], done[1]
    for more in done[2:]:
        upper = upper.unionByName(more)
    upper = stages.write(
        upper.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(_NOTHING))).drop("ends"), "upper"
    )
    parents = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("__parent"))
    every = inner.unionByName(upper.select(inner.columns))
    open_parent = every.where(F.col("parent_key").isNotNull()).join(parents, "parent_key").withColumn("parent_conv_id", F.col("__parent"))
    return every.where(F.col("parent_key").isNull()).select(*NODE_COLUMNS).unionByName(open_parent.select(*NODE_COLUMNS))
