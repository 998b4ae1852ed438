"""Exact and near duplicates against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages
from tapweave.llm import exactdup, neardup

SCHEMA = "doc_id bigint, text string, kept string, n int"


@pytest.fixture()
def stages(spark):
    with Stages(spark) as s:
        yield s


def landed(spark, stages, rows, files=3):
    path = stages.path("docs")
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(path)
    return path


ROWS = [
    (1, "a b", "x", 1), (2, " ab\n", "x", 2), (3, "a  b  ", "x", 3), (4, "other", None, None), (5, None, "x", 5), (6, "", "x", 6),
    (7, " \t", "x", 7), (4, "other", "x", 8), (None, "other   ", "x", 9), (8, "long " * 60_000, "x", 10), (9, "a b", "x", 11),
]


def brute(rows):
    def body(t):
        return re.sub("[\x20\x09-\x0d]", "", t or "")

    out = []
    for doc, text, *_ in rows:
        group = [r for r in rows if body(r[1]) == body(text)]
        best = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out.append((doc, best[0], len(group)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_exact_against_brute_force(spark, stages, files_per_batch):
    path = landed(spark, stages, ROWS)
    out = exactdup.mark(spark, path, stages, files_per_batch=files_per_batch).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in out), key=repr) == brute(ROWS)
    kept = sorted((r["doc_id"] for r in out if r["kept"]), key=repr)
    assert kept == sorted([3, None, 7, 8, 9], key=repr)


def test_colliding_digests_are_told_apart_by_their_bytes(spark, stages):
    path = landed(spark, stages, ROWS)
    out = exactdup.mark(spark, path, stages, digest=lambda text: F.substring(exactdup.sha256(text), 1, 0)).collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in out), key=repr) == brute(ROWS)


def test_keep_first_returns_its_input_columns(spark, stages):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    out = exactdup.keep_first(docs, stages)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["kept"], r["n"]) for r in out.collect() if r["doc_id"]) == [
        (3, "x", 3), (7, "x", 7), (8, "x", 10), (9, "x", 11)]
    assert exactdup.keep_first(docs.where("false"), stages).collect() == []


def test_state_lives_on_disk_and_meets_a_second_arrival(spark, tmp_path):
    """Rows added later meet the saved state; earlier files are not streamed again, also after a stop in between."""
    path, home = str(tmp_path / "docs"), str(tmp_path / "home")
    later = [(100 + i, text, "y", 100 + i) for i, (_, text, *_) in enumerate(ROWS)] + [(200, "only here", "y", 200), (None, "only here", "y", 0)]
    seen = []
    for rows in (ROWS, later, [(300, "third", "z", 1)]):
        seen += rows
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(path)
        with Stages(spark) as stages:  # what a run wrote for itself is gone with it
            out = exactdup.mark(spark, path, stages, home=home).collect()
        assert sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in out), key=repr) == brute(seen)
    landed = spark.read.option("basePath", f"{home}/digests").parquet(f"{home}/digests/*")
    assert sorted(r["count"] for r in landed.groupBy("batch").count().collect()) == sorted([len(ROWS), len(later), 1])
    kept = [p for p in (tmp_path / "home" / "stream" / "state").rglob("*") if p.suffix in (".zip", ".changelog")]
    assert kept
    # a run that stopped after landing goes on with the state stream
    spark.createDataFrame([(400, "third", "z", 1)], SCHEMA).write.mode("append").parquet(path)
    with Stages(spark) as stages:
        exactdup.stream_digests(spark, path, stages, home=home)
    with Stages(spark) as stages:
        state = exactdup.stream_state(spark, path, stages, home=home)
        assert state.where("first.id = 300").first()["members"] == 2
        assert state.agg(F.sum("members")).first()[0] == len(seen) + 1
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")  # the session's own setting is back


def test_mark_of_an_empty_table(spark, stages):
    path = landed(spark, stages, ROWS[:0])
    assert exactdup.mark(spark, path, stages).collect() == []


# ---------------------------------------------------------------- near duplicates


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def sets_of(rows):
    out = {}
    for doc, text in rows:
        w = words_of(text)
        out[doc] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    return out


def brute_components(rows, percent):
    sets = sets_of(rows)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def family(seed, n, size, changes, start):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(size)]
    rows = []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        rows.append((start + i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("percent", [85, 80])
def test_near_against_brute_force(spark, stages, percent):
    rows = [
        *family(1, 60, 120, 6, 0), *family(2, 40, 60, 5, 100), *family(3, 30, 400, 12, 200), *family(4, 20, 12, 1, 300),
        (400, "One two three"), (401, "one  TWO\nthree"), (402, "one two"), (403, ""), (404, None), (405, " \n"), (406, "Éa b c d e"),
        (407, "éa b c d e"), (408, "word " * 30_000), (409, "word " * 9),
    ]
    params = neardup.NearDup(percent=percent) if percent == 85 else neardup.NearDup(percent=80, bands=50, rows=7)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = neardup.groups(docs, stages, params).collect()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out}
    assert got == brute_components(rows, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_leaves_of_a_failed_star_are_found(spark, stages):
    """Two leaves are near each other, their common centre is near neither."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    far = list(base)
    for i in range(0, 200, 24):
        far[i] = f"y{i}"
    rows = [(0, " ".join(base)), (1, " ".join(far))]
    for i in range(2, 30):
        copy = list(far)
        copy[rng.randrange(200)] = f"z{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.groups(docs, stages).collect()}
    assert got == brute_components(rows, 85)


def test_leaf_pairs_lose_nothing(spark):
    """Leaves at every distance of their centre; those similar to it are its component."""
    rng = random.Random(9)
    for percent in (85, 80):
        sets, stars = [], []
        for f in range(5):
            center = len(sets)
            base = [rng.getrandbits(40) for _ in range(40)]
            sets.append((center, sorted(base)))
            sub = set(base[8:]) | {rng.getrandbits(40) for _ in range(6)}
            for i in range(24):
                s = set(base) if i % 2 else set(sub)
                for _ in range(rng.randrange(7)):
                    s.discard(rng.choice(base))
                    s.add(rng.getrandbits(40))
                node, common = len(sets), len(s & set(base))
                near = 100 * common >= percent * (len(s) + 40 - common)
                sets.append((node, sorted(s)))
                stars.append((center, node, center if near else node))
        params = neardup.NearDup(percent=percent)
        df = neardup.leaf_pairs(
            spark.createDataFrame(stars, "center bigint, node bigint, component bigint"),
            spark.createDataFrame(sets, "node bigint, s array<bigint>"), params)
        got = {tuple(sorted((r["a"], r["b"]))) for r in df.collect()}
        by_node, found = dict(sets), 0
        for (c1, a, x), (c2, b, y) in combinations(stars, 2):
            common = len(set(by_node[a]) & set(by_node[b]))
            if c1 == c2 and x != y and 100 * common >= percent * (len(by_node[a]) + len(by_node[b]) - common):
                found += 1
                assert (a, b) in got
        assert found > 20


def test_repeated_and_null_ids(spark, stages):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(5, text, "a", 1), (5, text, "b", 2), (None, text, "c", 3), (5, "other words here", "d", 4), (2, text + " end", "e", 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = neardup.groups(docs, stages).collect()
    got = sorted(((r["doc_id"], r["component_id"]) for r in out), key=repr)
    assert got == sorted([(5, 2), (5, 2), (None, None), (5, 5), (2, 2)], key=repr)
    kept = neardup.keep_one(docs.withColumn("digest", F.lit(1)), stages)
    assert kept.columns == [*docs.columns, "digest"]
    assert neardup.groups(docs.where("false"), stages).collect() == []


def test_a_reused_id_is_dropped_for_its_own_text_only(spark, stages):
    a, b = (" ".join(f"{c}{i}" for i in range(50)) for c in "ab")
    rows = [(5, a, "a", 1), (2, a + " end", "a", 2), (5, b, "b", 3), (9, b + " end", "b", 4), (5, None, "c", 5), (5, "a text of its own", "c", 6)]
    kept = neardup.keep_one(spark.createDataFrame(rows, SCHEMA).withColumn("digest", F.lit(1)), stages).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted([(2, a + " end"), (5, b), (5, None), (5, "a text of its own")], key=repr)


def test_densification_keeps_the_similarity():
    """Equal bins of two signatures estimate the similarity, also for tiny sets."""
    maker = neardup.Sketcher(neardup.NearDup())
    rng = np.random.default_rng(0)
    for n in (6, 40, 2000):
        errors = []
        for _ in range(40):
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            y = np.unique(np.concatenate([x[: int(n * 0.8)], rng.integers(0, 1 << 63, n - int(n * 0.8), dtype=np.uint64)]))
            true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
            errors.append((maker.signature(x) == maker.signature(y)).mean() - true)
        assert abs(np.mean(errors)) < 0.03
    assert neardup.NearDup().missed() < 2e-6


def test_components_of_a_long_path(spark, stages):
    n = 300
    path = list(range(n))
    random.Random(3).shuffle(path)
    edges = spark.createDataFrame([(a, b) for a, b in zip(path, path[1:])] + [(1000, 1001)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in neardup.components(edges, stages).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def test_leaves_that_share_a_passage_do_not_meet(spark):
    """2,000 leaves of one component with one added passage make no joined rows; those of another one meet only where they can be similar."""
    params = neardup.NearDup(percent=80)
    center = list(range(1, 101))
    passage = list(range(1000, 1005))
    sets = [(0, center)] + [(i, center[3:] + passage + [10_000 + i]) for i in range(1, 2001)]
    stars = [(0, i, 0) for i in range(1, 2001)]
    schema = "center long, node long, component long"
    frame = spark.createDataFrame(sets, "node long, s array<bigint>")
    assert neardup.meeting_places(spark.createDataFrame(stars, schema), frame, params).isEmpty()
    # three far leaves: 2001 and 2002 share most of theirs and the passage, 2003 the passage only
    far = [(2001, center[40:] + passage + list(range(3000, 3060))), (2002, center[40:] + passage + list(range(3000, 3059)) + [9]),
           (2003, center[60:] + passage + list(range(4000, 4060)))]
    frame = spark.createDataFrame(sets + far, "node long, s array<bigint>")
    stars += [(0, n, n) for n, _ in far]
    places = neardup.meeting_places(spark.createDataFrame(stars, schema), frame, params).collect()
    got = {tuple(r) for r in neardup.leaf_pairs(spark.createDataFrame(stars, schema), frame, params).collect()}
    assert (2002, 2001) in got
    by_id = dict(sets + far)
    similar = {(a, b) for a, _ in far for b in by_id if a > b > 0 and len(set(by_id[a]) & set(by_id[b])) * 180 >= 80 * (len(by_id[a]) + len(by_id[b]))}
    assert similar <= got and len(got) < 10
    pairs = Counter((r["center"], r["token"]) for r in places)
    assert sum(n * n for n in pairs.values()) < 40_000_000 and len(places) < 20_000


def test_blocks_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "LEAVES_PER_BLOCK", 2)
    params = neardup.NearDup(percent=80)
    rng = random.Random(4)
    base = list(range(60))
    sets, stars = [(0, base)], []
    for i in range(1, 60):
        family = i % 6
        s = base[20:] + [100 + 50 * family + k for k in range(25)] + [9000 + rng.randrange(40) for _ in range(3)]
        sets.append((i, sorted(set(s))))
        stars.append((0, i, i))
    frame = spark.createDataFrame(sets, "node long, s array<bigint>")
    got = {tuple(r) for r in neardup.leaf_pairs(spark.createDataFrame(stars, "center long, node long, component long"), frame, params).collect()}
    similar = {
        (a, b) for a, x in sets[1:] for b, y in sets[1:] if a > b and len(set(x) & set(y)) * 180 >= 80 * (len(x) + len(y))
    }
    assert similar and similar <= got


def test_further_centres_join_what_the_first_is_not_connected_with(spark):
    # bucket 1: centre 1 lies apart, 2 and 3 are joined elsewhere; bucket 2 is whole; bucket 3 has two members
    rows = [(1, 0, n, 10, 4) for n in (1, 2, 3, 4)] + [(2, 0, 5, 10, 3), (2, 1, 6, 10, 3), (2, 1, 7, 10, 3), (3, 0, 8, 10, 2), (3, 0, 9, 10, 2)]
    members = spark.createDataFrame(rows, "key int, part int, node bigint, n int, size int")
    live = members.groupBy("key", "part").agg(F.min("node").alias("center"))
    labels = spark.createDataFrame([(2, 2), (3, 2), (5, 5), (6, 5), (7, 5)], "node bigint, component bigint")
    centres = spark.createDataFrame([(1, 1), (2, 5), (3, 8)], "key int, node bigint")
    apart, seconds = neardup._further_centres(members, live, labels, centres)
    assert sorted((r.key, r.node) for r in apart.collect()) == [(1, 2), (1, 3), (1, 4)]
    assert [(r.key, r.s.node) for r in seconds.collect()] == [(1, 2)]
    assert [(r.a, r.b) for r in neardup._further_stars(apart, live, seconds, 85).collect()] == [(4, 2)]
    # the next round has another centre, also where nobody was joined to this one
    apart, seconds = neardup._further_centres(members, live, labels, centres.unionByName(seconds.select("key", "s.node")))
    assert [(r.key, r.s.node) for r in seconds.collect()] == [(1, 4)]
    assert neardup._further_stars(apart, live, seconds, 85).isEmpty()
