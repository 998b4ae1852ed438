"""Prefix trie, periodic runs and row rules against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapweave.functions.stage import Stages
from tapweave.llm import periodic, prefixtrie, rowrules
from tapweave.llm.common import id_crc, table
from tapweave.llm.queries import (
    held_out, op11_quality_rules, op12_periodic_runs, op13_prefix_trie, with_planted_tail,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture()
def stages(spark):
    with Stages(spark) as s:
        yield s


# ---------------------------------------------------------------- trie


def brute_trie(turns):
    """Nodes of (conv_id, turn, role, text) rows by walking every prefix."""
    own = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    for c, rows in own.items():
        rows.sort(key=lambda r: (r[0], r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = tuple((r[2], r[3]) for r in own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(set)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = sum(1 for p in below if not children[p])
        saved = sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ended = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children[path]), leaves, saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(map(repr, out))


def trie_of(spark, rows, stages, params):
    frame = spark.createDataFrame(
        [(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, depth int"
    )
    told = prefixtrie.with_shared_heads(prefixtrie.paths(frame), 20, id_crc("conv_id") % 4)
    return sorted(repr(tuple(r)) for r in prefixtrie.nodes(told, stages, params).collect())


def conversations(seed):
    rng = random.Random(seed)
    rows = [(None, 1, "user", "nobody"), (7, None, None, None), (7, None, "user", "x y"), (7, 3, "user", ""), (-5, 0, "a", "neg"), (-21, 0, "a", "neg")]
    rows += [(40, i, "user", f"deep {i // 2}") for i in range(60)] + [(41, i, "user", f"deep {i // 2}") for i in range(45)]
    rows += [(500, 0, "system", "word " * 20_000)]
    for c in range(60, 300):
        if rng.random() < 0.4:  # copies of one conversation
            rows += [(c, i, "user", f"same {i}") for i in range(4)]
        else:
            rows += [(c, rng.randrange(3), rng.choice(["user", "system"]), rng.choice(["p q", "r", ""])) for _ in range(rng.randrange(1, 6))]
    rows += rows[20:60]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("params", [prefixtrie.TrieParams(), prefixtrie.TrieParams(turns=40, open_paths=9, ids=3), prefixtrie.TrieParams(turns=400)])
@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_walk(spark, stages, seed, params):
    rows = conversations(seed)
    assert trie_of(spark, rows, stages, params) == brute_trie(rows)


def test_trie_of_little(spark, stages):
    params = prefixtrie.TrieParams(turns=1)
    assert trie_of(spark, [], stages, params) == []
    one = [(3, 0, None, None)]  # three turns are taken from a conversation that is absent
    assert trie_of(spark, one, stages, params) == brute_trie(one)


def test_trie_query_whatever_the_tasks(spark, stages):
    told = prefixtrie.with_shared_heads(prefixtrie.paths(table(spark, SF, "conversations")), 20, id_crc("conv_id") % 4)
    split = prefixtrie.nodes(told, stages, prefixtrie.TrieParams(turns=60, open_paths=5, ids=2))
    assert sorted(map(repr, split.collect())) == sorted(map(repr, op13_prefix_trie(spark, SF).collect()))


# ---------------------------------------------------------------- runs


def brute_runs(words, least):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if i > s and length >= max(least, 2 * q):
                run = words[s : s + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    out.append((s, length, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("letters", [1, 2, 3, 6, 40])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(150):
        n = rng.randrange(0, 90)
        words = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.6:
            p, s = rng.randrange(1, n // 2 + 2), rng.randrange(n)
            for i in range(s + p, n):
                words[i] = words[i - p]
        for least in (2, 3, 12):
            assert periodic.find_runs(words, periodic.RunParams(least)) == brute_runs(words, least)


def test_every_square_has_its_smallest_period():
    words = [0, 1, 0, 1, 0, 1, 0, 1, 2, 2, 2, 0, 1, 0, 1]
    found = {(end, period) for end, period, _ in periodic.squares(words)}
    assert {(3, 2), (7, 2), (9, 1), (10, 1), (14, 2)} <= found and not {p for _, p in found if p > 2}


def digest_row(doc_id, text):
    words = with_planted_tail(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words, 12)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    said = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest(),
    )


def test_runs_query_equals_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    short = {r["doc_id"] for r in docs if len((r["text"] or "").split()) < 1200}  # the brute force is quadratic
    got = op12_periodic_runs(spark, SF).collect()
    assert len(got) == len(docs)
    got = [tuple(r) for r in got if r["doc_id"] in short]
    assert sorted(got) == sorted(digest_row(r["doc_id"], r["text"]) for r in docs if r["doc_id"] in short)
    assert len(short) > 150 and sum(r[1] > 0 for r in got) > 20


def test_runs_of_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, " \n\t"), (None, "a b " * 30), (4, "é è " * 20), (4, "é è " * 20), (10, "x y z " * 40_000), (5, "\x1c a\x1c " * 9)]
    docs = spark.createDataFrame([(*r, "keep", 5) for r in odd], "doc_id long, text string, runs string, __best int")
    found = periodic.with_runs(docs, rewrite=with_planted_tail)
    assert found.columns == [*docs.columns, "periodic"] and {r["runs"] for r in found.collect()} == {"keep"}
    want = [digest_row(*r) if r[0] not in (10, None) else None for r in odd]
    got = {r["doc_id"]: tuple(r) for r in periodic.digested(found).collect()}
    assert all(got[w[0]] == w for w in want if w)
    assert got[10][1:6] == (1, 0, 120_000, 3, 40_000_000)
    assert got[None][1:6] == (1, 0, 60, 2, 30_000)
    assert periodic.digested(periodic.with_runs(docs.where("false"))).collect() == []


# ---------------------------------------------------------------- rules


def brute_counts(text, window=8):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    inside = {i + k for i in range(len(words) - window + 1) if grams[tuple(words[i : i + window])] > 1 for k in range(window)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)
    )


def test_counts_on_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = op11_quality_rules(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= 0.5)


@pytest.mark.parametrize("text", ["", "a", "a b c d e f g h " * 2, "x\n\nx\n \nx \n", "é #|\n" * 3, "w " * 9, " ".join(map(str, range(30))) + " " + " ".join(map(str, range(5, 14)))])
def test_counts_of_odd_texts(text):
    words = text.encode().split()
    assert rowrules.counts(text, words, 8) == brute_counts(text)


def test_held_out_rows_are_judged_right(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels").where(held_out(3, 1))
    rows = op11_quality_rules(spark, sf).join(labels, "doc_id").select("quality", "kept", "score").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows) / len(rows)
    assert len(rows) > 100 and right > 0.95
    # probabilities mean what they say, on average
    assert abs(np.mean([r["score"] for r in rows]) - np.mean([r["quality"] for r in rows])) < 0.08


def test_calibration_recovers_a_line():
    rng = np.random.default_rng(3)
    raw = rng.normal(size=4000)
    ys = (rng.random(4000) < 1 / (1 + np.exp(-(2.5 * raw - 1)))).astype(int)
    slope, shift = rowrules.calibrate(raw, ys, np.ones(4000))
    assert slope == pytest.approx(2.5, abs=0.25) and shift == pytest.approx(-1, abs=0.15)
    assert rowrules.calibrate(raw, np.ones(4000, int), np.ones(4000)) == (1.0, 0.0)
    # a weight of two is a row twice
    twice = rowrules.calibrate(np.repeat(raw[:50], 2), np.repeat(ys[:50], 2), np.ones(100))
    assert rowrules.calibrate(raw[:50], ys[:50], np.full(50, 2.0)) == pytest.approx(twice, rel=0.2, abs=0.2)


def test_rules_on_odd_tables(spark):
    odd = [(1, None), (2, ""), (3, "plain words " * 9), (3, "other text"), (None, "x"), (4, "long " * 200_000), (5, "a!! b!! " * 12)]
    docs = spark.createDataFrame([(*r, "keep", 1) for r in odd], "doc_id long, text string, score string, label int")
    labels = spark.createDataFrame(
        [(1, 0, "c"), (2, 1, "c"), (3, 1, "c"), (3, None, "c"), (None, 1, "c"), (5, 0, "c"), (99, 1, "c"), (3, 1, "c")], "doc_id long, quality int, text string"
    )
    model = rowrules.fit(docs, labels, F.lit(True))
    out = rowrules.with_verdict(docs, model)
    assert out.columns == [*docs.columns, "quality_rules"]
    rows = out.collect()
    assert len(rows) == len(odd) and all(0 <= r["quality_rules"]["score"] <= 1 and r["score"] == "keep" for r in rows)
    assert not any(r["quality_rules"]["kept"] for r in rows if not (r["text"] or "").split())
    one_class = rowrules.fit(docs, labels.where("quality = 1"), F.lit(True))
    assert {r["quality_rules"]["score"] for r in rowrules.with_verdict(docs, one_class).collect()} == {1.0}
    assert rowrules.fit(docs, labels.where("false"), F.lit(True)).weights is None
    assert rowrules.with_verdict(docs.where("false"), model).collect() == []


def test_sample_has_one_text_an_id(spark):
    rows = [(1, f"good text {i}") for i in range(300)] + [(2, "bad!! bad!!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    again = spark.createDataFrame([min(r for r in rows if r[0] == 1), rows[-1]], "doc_id long, text string")
    a, b = rowrules.fit(docs, labels, F.lit(True)), rowrules.fit(again, labels, F.lit(True))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias
