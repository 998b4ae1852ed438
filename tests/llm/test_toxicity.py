import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapweave.llm import toxicity
from tapweave.llm.common import id_crc, table

DOCS = "doc_id bigint, text string, lang string, score double"
LABELS = "doc_id bigint, quality int, toxic int"


def plain_ftrl(rows, p):
    """The published rule, one coordinate at a time."""
    import math

    z, n = {}, {}
    bias = 1 << p.bits

    def weight(i):
        zi = z.get(i, 0.0)
        l1 = 0 if i == bias else p.l1
        if abs(zi) <= l1:
            return 0.0
        return -(zi - math.copysign(l1, zi)) / ((p.beta + math.sqrt(n.get(i, 0.0))) / p.alpha + p.l2)

    for _ in range(p.epochs):
        for found, y in rows:
            at = [*found.tolist(), bias]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i in at:
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / p.alpha
                z[i] = z.get(i, 0.0) + g - s * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return weight


def test_training_follows_the_rule():
    p = toxicity.Ftrl(bits=12, l1=0.2, epochs=2)
    texts = [("you are a moron", 1), ("have a nice day", 0), ("what a moron he is", 1), ("the day is nice", 0)] * 3
    rows = [(toxicity.features(t, p), y) for t, y in texts]
    weights, bias = toxicity.train(rows, p)
    want = plain_ftrl(rows, p)
    assert bias == pytest.approx(want(1 << p.bits))
    for i in np.unique(np.concatenate([f for f, _ in rows])):
        assert weights[i] == pytest.approx(want(int(i)))


def test_features_are_words_stems_and_pairs():
    p = toxicity.Ftrl()
    assert len(toxicity.features("alpha", p)) == 2  # word and stem
    assert len(toxicity.features("alpha beta", p)) == 5
    assert (toxicity.features("Alpha, BETA!", p) == toxicity.features("alpha beta", p)).all()
    assert len(toxicity.features(None, p)) == len(toxicity.features(" ?! ", p)) == 0


def test_nulls_empty_long_and_repeated_rows(spark):
    docs = spark.createDataFrame(
        [(1, "you moron", "en", 9.0), (2, "kind words", "en", 9.0), (3, None, None, None), (4, "", "en", 1.0),
         (5, "kind words " * 30_000 + "moron", "en", 1.0), (None, "you moron", "en", 1.0), (1, "you moron", "en", 9.0)], DOCS)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 1, 0), (2, None, None), (None, 1, 1), (99, 1, 1)], LABELS)
    model = toxicity.fit(docs, labels, F.lit(True), toxicity.Ftrl(l1=0.1, epochs=20))
    out = toxicity.with_score(docs, model).collect()
    assert len(out) == 7 and all(0 <= r["score"] <= 1 for r in out)
    score = {r["doc_id"]: r["score"] for r in out if r["doc_id"]}
    assert score[3] == score[4]
    assert score[1] > 0.5 > score[2]
    assert sorted(r["score"] for r in out if r["text"] == "you moron") == [score[1]] * 3


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "you moron", "en", 9.0)], DOCS)
    none = spark.createDataFrame([], LABELS)
    model = toxicity.fit(docs, none, F.lit(True))
    assert [(r["score"], r["predicted"]) for r in toxicity.with_score(docs, model).collect()] == [(0.0, 0)]
    empty = docs.where("false")
    assert toxicity.with_score(empty, toxicity.fit(empty, none, F.lit(True))).collect() == []


def test_held_out_accuracy(spark):
    """Learned on four fifths of the labels of sf0.1, judged on the rest."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels, id_crc() % 5 != 0)
    assert len(model.features) < 20_000
    held = toxicity.with_score(docs.join(labels, "doc_id").where(id_crc() % 5 == 0), model).toPandas()
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held["doc_id"])
    assert (held["predicted"] == held["toxic"]).mean() > 0.96
