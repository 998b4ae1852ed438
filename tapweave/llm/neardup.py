"""Near-duplicate groups by one-permutation MinHash.

1. *Sketch.* A text is its set of hashed five-word shingles. The hash range is
   cut into bins and each bin keeps its least value; an empty bin borrows from
   the first filled bin in its own random order of all bins (optimal
   densification, Shrivastava 2017). Runs of bins are hashed to band keys.
2. *Classes.* Equal sets are one node. Copies cost no pairs.
3. *Stars.* The nodes of a bucket (equal band key) are linked to the bucket's
   smallest node only, so pairs grow with the rows. Each is confirmed on the
   full sets.
   Buckets left in pieces get stars around up to two further centres.
4. *The rest.* A bucket of three or more nodes whose star did not join all of
   them may hide a link between two leaves. All leaves of such buckets go
   through an exact join on how they differ from their centre (``leaf_pairs``):
   what a whole family has in common makes no pairs. Pairs already connected are
   left out. No bucket is capped.
5. *Components* by hooking to the smallest neighbour and jumping, edges
   contracted and written in every round.

A pair at the threshold is missed with a probability of (1 - t^rows)^bands,
about one in a million with the defaults; all that is found is exact.

Defined results: a text of fewer words than a shingle is one shingle; without
words or text the set is empty and linked with nothing, the component is the
document itself; rows without an id have no component and are kept; a repeated
row is a copy of itself, both rows are kept if theirs is the smallest id; an
empty table gives no rows; other columns are passed through by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tapweave.functions.stage import Stages
from tapweave.llm.common import likely

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class NearDup:
    """``percent``: least Jaccard similarity; ``bands`` times ``rows`` is the number of bins."""

    words: int = 5
    percent: int = 85
    bands: int = 44
    rows: int = 8
    seed: int = 1

    @property
    def bins(self) -> int:
        return self.bands * self.rows

    def missed(self) -> float:
        """Probability that a pair at the threshold shares no bucket."""
        return (1 - (self.percent / 100) ** self.rows) ** self.bands


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    found = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z, blank, tab to CR
    n = len(found)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found))], np.uint64)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, n)
    mixed = hashed[: n - words + 1].copy()
    for j in range(1, words):
        mixed = mixed * _ODD + hashed[j : n - words + 1 + j]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _ODD2
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


class Sketcher:
    """Signatures and band keys of shingle sets."""

    def __init__(self, params: NearDup):
        self.params = params
        k = params.bins
        # each bin's random order of all bins, as ranks
        self.ranks = np.random.default_rng(params.seed).random((k, k)).argsort(axis=1).argsort(axis=1).astype(np.uint32)

    def signature(self, found: np.ndarray) -> np.ndarray:
        k = self.params.bins
        bins = (((found >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        filled = bins[first]
        values = np.zeros(k, np.uint64)
        values[filled] = found[first]
        is_empty = np.ones(k, bool)
        is_empty[filled] = False
        empty = np.flatnonzero(is_empty)
        if len(empty):
            values[empty] = found[first][self.ranks[np.ix_(empty, filled)].argmin(axis=1)]
        return values

    def keys(self, signature: np.ndarray) -> np.ndarray:
        p = self.params
        rows = signature.reshape(p.bands, p.rows)
        key = np.arange(1, p.bands + 1, dtype=np.uint64) * _ODD2
        for j in range(p.rows):
            key = (key ^ rows[:, j]) * _ODD
            key ^= key >> np.uint64(31)
        return key.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in parts]))), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64()))


def sketch(docs: DataFrame, params: NearDup = NearDup()) -> DataFrame:
    """doc_id, n (set size), digest (of the set; null if empty) and bands (keys) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(params)
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in batch.column("text"):
                found = shingles(text.as_py(), params.words)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signature = maker.signature(found) if len(found) else None
                bands.append(maker.keys(signature) if len(found) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                 _lists(bands)],
                ["doc_id", "n", "digest", "bands"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SKETCH)


SKETCH = "doc_id bigint, n int, digest binary, bands array<bigint>"


def full_sets(docs: DataFrame, params: NearDup = NearDup()) -> DataFrame:
    """doc_id, digest and full set of shingles (s) of every row that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), params.words) for t in batch.column("text")]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(digests, pa.binary()), _lists([s.view(np.int64) for s in sets])],
                ["doc_id", "digest", "s"],
            )

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, digest binary, s array<bigint>")
    return found.where("digest IS NOT NULL")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    whole = (F.size("sa") + F.size("sb")).cast("long")
    return pairs.join(left, "a").join(right, "b").where(common * (100 + percent) >= whole * percent).select("a", "b")


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """node and component (smallest node it is connected with) of all nodes of the edges (a, b)."""
    labels = None
    edges = stages.write(edges.select("a", "b").where("a <> b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        hook = stages.write(hook.select("node", F.least("node", "to").alias("to")), "hooks")
        for _ in range(2):  # pointers of pointers
            up = hook.select(F.col("node").alias("to"), F.col("to").alias("up"))
            hook = hook.join(up, "to", "left").select("node", F.coalesce("up", "to").alias("to"))
        hook = stages.write(hook, "jumps")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            new = hook.select(F.col("node").alias("component"), "to")
            labels = labels.join(new, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            labels = stages.write(labels, "labels")
        at_a = hook.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        at_b = hook.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = edges.join(at_a, "a").join(at_b, "b").where("ta <> tb").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        edges = stages.write(edges.distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


# Rounds of stars around further centres, before what is left is joined exactly.
FURTHER_STARS = 2

# Parts that the members of a bucket are dealt over by their hash.
BUCKET_PARTS = 64

# Leaves per block of a group that is joined with itself.
LEAVES_PER_BLOCK = 1000


def meeting_places(stars: DataFrame, sets: DataFrame, params: NearDup) -> DataFrame:
    """center, token, df, and node, component, n, d and at of the leaves that have to meet there, see ``leaf_pairs``."""
    p = params.percent
    own = sets.select("node", "s")
    middle = sets.select(F.col("node").alias("center"), F.col("s").alias("c"))
    both = stars.select("center", "node", "component").join(own, "node").join(middle, "center")
    added, missing = F.array_except("s", "c"), F.transform(F.array_except("c", "s"), lambda x: F.bitwise_not(x))
    told = both.select("center", "node", "component", F.size("s").alias("n"), F.concat(added, missing).alias("delta"))
    told = told.withColumn("d", F.size("delta"))
    # no partner at this centre differs from it in fewer places
    least = told.groupBy("center").agg(F.min("d").alias("least"))
    told = told.join(least, "center")
    tokens = told.select("center", "node", "component", F.explode("delta").alias("token"))
    often = tokens.groupBy("center", "token").agg(
        F.count(F.lit(1)).alias("df"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low < high").drop("low", "high")
    shared = tokens.drop("component").join(often, ["center", "token"])
    by_node = Window.partitionBy("center", "node")
    # differences that nobody of another component has come first
    placed = shared.withColumns({"__shared": F.count(F.lit(1)).over(by_node), "__k": F.row_number().over(by_node.orderBy("df", "token"))})
    placed = placed.join(told.drop("delta"), ["center", "node"]).withColumn("at", F.col("d") - F.col("__shared") + F.col("__k") - 1)
    largest = F.col("n") + F.floor(F.col("n") * 100 / p)
    widest = largest - 2 * F.ceil(largest * p / (100 + p)) + 2  # no D is above it, whatever the partner's size
    reach = (F.col("d") - F.col("at")) * 2 >= F.col("d") + F.col("least") - widest
    return placed.where(reach).select("center", "token", "df", "node", "component", "n", "d", "at")


def leaf_pairs(stars: DataFrame, sets: DataFrame, params: NearDup) -> DataFrame:
    """Pairs (a, b) of nodes around one centre, of different components, that can be similar enough: none that is, is missing.

    ``stars`` has center, node and component, where a node similar to its centre
    has the centre's component; ``sets`` has node and s. A node is described by
    how it differs from its centre: shingles added, and shingles missing
    (complemented). Two nodes whose differences have d1 and d2 members share
    more than (d1 + d2 - D) / 2 of these if they are similar, D being the
    largest symmetric difference of similar sets of their sizes; that is above 0
    unless both are similar to the centre. So they meet in a shared difference.
    Only differences that leaves of several components have can be shared by such
    a pair. They are ordered from rare to frequent; the places of the first shared
    one bound the number that can be shared, so a leaf goes only to places from
    which enough can follow. Leaves of one component that share a passage meet
    nowhere. What meets in one place is divided into numbered blocks, which meet
    pairwise in different tasks.
    """
    p = params.percent
    placed = meeting_places(stars, sets, params).withColumn("blocks", F.ceil(F.col("df") / LEAVES_PER_BLOCK).cast("int"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ("node", "component", "n", "d", "at")
    a = placed.select("center", "token", *(F.col(c).alias(f"{c}_a") for c in columns), block.alias("here"), every.alias("there"))
    b = placed.select("center", "token", *(F.col(c).alias(f"{c}_b") for c in columns), block.alias("there"), every.alias("here"))
    whole = (F.col("n_a") + F.col("n_b")).cast("long")
    apart = whole - 2 * F.ceil(whole * p / (100 + p))  # D
    most = F.least(F.col("d_a") - F.col("at_a"), F.col("d_b") - F.col("at_b"))
    met = a.join(b, ["center", "token", "here", "there"]).where(
        (F.col("node_a") > F.col("node_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * p)
        & (most * 2 >= F.col("d_a") + F.col("d_b") - apart)
    )
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _further_centres(members: DataFrame, live: DataFrame, labels: DataFrame, centres: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members that are not connected with any centre (key, node) of their bucket so far, and the least of them by bucket as s.

    Where a large bucket's first centre lies apart from the others, a star around a further one joins these at a row each.
    """
    pieces = members.where("size > 2").join(labels, "node", "left")
    pieces = pieces.select("key", "part", "node", "n", F.coalesce("component", "node").alias("component"))
    split = pieces.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    homes = centres.join(labels, "node", "left").groupBy("key").agg(F.collect_set(F.coalesce("component", "node")).alias("homes"))
    told = live.select("key", "part").join(split.select("key").join(homes, "key"), "key")
    apart = pieces.join(told, ["key", "part"]).where(~F.array_contains("homes", F.col("component"))).drop("homes")
    return apart, apart.groupBy("key").agg(F.min(F.struct("node", "n", "component")).alias("s"))


def _further_stars(apart: DataFrame, live: DataFrame, seconds: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the members of ``apart`` and their bucket's next centre that can be similar enough."""
    told = live.select("key", "part").join(seconds, "key")
    near = F.least("n", "s.n") * 100 >= F.greatest("n", "s.n") * percent
    pairs = apart.join(told, ["key", "part"]).where((F.col("component") != F.col("s.component")) & near)
    return pairs.select(F.col("node").alias("a"), F.col("s.node").alias("b")).distinct()


def groups(docs: DataFrame, stages: Stages, params: NearDup = NearDup()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) of every row of ``docs``."""
    return _decided(docs, stages, params).drop("digest")


def _decided(docs: DataFrame, stages: Stages, params: NearDup) -> DataFrame:
    """``groups`` with the digest of the row's set."""
    p = params.percent
    rows = stages.write(sketch(docs, params), "sketch")
    classes = rows.where("digest IS NOT NULL").groupBy("digest")
    classes = classes.agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = stages.write(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    # buckets of several nodes
    # a bucket may hold a third of all nodes, so its members stay in numbered parts: the least of a part, then the least of parts
    part = F.pmod(F.xxhash64("node"), F.lit(BUCKET_PARTS)).cast("int").alias("part")
    placed = nodes.select("node", "n", part, F.explode("bands").alias("key"))
    counted = placed.groupBy("key", "part").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("size"))
    whole = Window.partitionBy("key")
    counted = counted.withColumns({"center": F.min("center").over(whole), "size": F.sum("size").over(whole)})
    live = stages.write(counted.where("size > 1"), "buckets")
    members = stages.write(placed.join(live, ["key", "part"]), "members")

    # stars, confirmed on full sets
    sizes = nodes.select(F.col("node").alias("center"), F.col("n").alias("n_center"))
    star = members.where("node <> center").select(F.col("node").alias("a"), "n", "center").distinct().join(sizes, "center")
    near = F.least("n", "n_center") * 100 >= F.greatest("n", "n_center") * p
    star = stages.write(star.where(near).select("a", F.col("center").alias("b")), "stars")
    sets = stages.write(_sets_of(docs, nodes, members, params), "sets")
    links = stages.write(confirmed(star, sets, p), "links")
    first = components(links, stages)

    centres = live.select("key", F.col("center").alias("node")).distinct()
    for _ in range(FURTHER_STARS):
        apart, seconds = _further_centres(members, live, first, centres)
        seconds = stages.write(seconds, "seconds")
        if seconds.isEmpty():
            break
        more = confirmed(_further_stars(apart, live, seconds, p), sets, p)
        links = stages.write(links.unionByName(more), "links")
        centres = centres.unionByName(seconds.select("key", "s.node"))
        first = components(links, stages)

    # buckets that the stars left in several pieces
    pieces = members.where("size > 2").join(first, "node", "left")
    pieces = pieces.select("key", "part", "center", "node", F.coalesce("component", "node").alias("component"))
    split = pieces.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    split = live.select("key", "part").join(split.select("key"), "key", "left_semi")
    left = pieces.join(split, ["key", "part"], "left_semi").where("node <> center")
    left = stages.write(left.select("center", "node", "component").distinct(), "left")
    rest = stages.write(leaf_pairs(left, sets, params), "rest")
    more = confirmed(rest, sets, p)
    final = components(links.unionByName(more), stages)

    # components get the smallest id of their members
    placed = nodes.select("digest", "id", "node").join(final, "node", "left")
    placed = placed.select("digest", "id", F.coalesce("component", "node").alias("component"))
    least = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    by_class = stages.write(placed.join(least, "component").select("digest", "component_id"), "classes")
    out = rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "digest").join(by_class, "digest", "left")
    own = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"), "digest")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _sets_of(docs: DataFrame, nodes: DataFrame, members: DataFrame, params: NearDup) -> DataFrame:
    """node and full set of every node that shares a bucket, made anew from the texts."""
    needed = nodes.select("digest", "node", F.col("id").alias("doc_id"))
    needed = needed.join(members.select("node").distinct(), "node", "left_semi")
    found = full_sets(likely(docs, needed, "doc_id"), params)
    own = found.alias("f").join(needed.alias("k"), "digest").where("f.doc_id <=> k.doc_id")
    one = own.groupBy("digest").agg(F.first("node").alias("node"), F.first("s").alias("s"))
    return one.select("node", "s")


def keep_one(docs: DataFrame, stages: Stages, params: NearDup = NearDup()) -> DataFrame:
    """``docs`` without all but one document of each group; its own columns only.

    The one with the smallest id stays, of repeated rows with that id all do.
    Only ids of dropped documents are joined back. Where rows share an id that is
    dropped with one text and kept with another, the text's set decides.
    """
    decided = stages.write(_decided(docs, stages, params).select("doc_id", "digest", "kept"), "decided")
    dropped = stages.write(decided.where("NOT kept").select("doc_id", "digest").distinct(), "dropped")
    sure = likely(docs, dropped, "doc_id", "left_anti")
    out = sure.unionByName(likely(docs, dropped, "doc_id").join(dropped, "doc_id", "left_anti"))
    reused = likely(decided.where("kept"), dropped, "doc_id").join(dropped, "doc_id", "left_semi").select("doc_id").distinct()
    reused = stages.write(reused, "reused")
    if not reused.isEmpty():
        rows = likely(docs, reused, "doc_id").join(reused, "doc_id", "left_semi").withColumn("__digest", _digest(params)("text"))
        gone = dropped.withColumnRenamed("digest", "__digest")
        out = out.select(docs.columns).unionByName(rows.join(gone, ["doc_id", "__digest"], "left_anti").select(docs.columns))
    return out.select(docs.columns)


def _digest(params: NearDup):
    """A function from texts to the digests that ``sketch`` gives their sets."""

    @F.pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        sets = [shingles(t, params.words) for t in texts]
        return pd.Series([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], index=texts.index, dtype=object)

    return digest
