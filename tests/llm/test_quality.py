from pyspark.sql import functions as F

from tapweave.llm import quality
from tapweave.llm.common import id_crc, table

PRINTED = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=15
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 0 <= 2.0)
      Predict: 0.0
     Else (feature 0 > 2.0)
      Predict: 1.0
    Else (feature 3 > 0.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 3 <= 0.5)
     Predict: 0.0
    Else (feature 3 > 0.5)
     Predict: 1.0
"""


def test_tree_paths_are_rules():
    names = quality.STATISTICS
    got = {r.conditions for r in quality.tree_paths(PRINTED, names)}
    low, high = (names[3], False, 0.5), (names[3], True, 0.5)
    assert got == {
        (low,), (high,), tuple(sorted([low, (names[0], False, 2.0)])), tuple(sorted([low, (names[0], True, 2.0)])),
    }


def test_statistics_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, "  \n\n "), (4, "A b | c!\nA b | c!"), (5, "word " * 40_000)], "doc_id bigint, text string"
    ).withColumn("digits", F.lit("clash"))
    rows = {r["doc_id"]: r for r in quality.with_statistics(docs).collect()}
    assert set(quality.STATISTICS) <= set(rows[1].asDict())
    for name in quality.STATISTICS:
        assert all(r[name] is not None and abs(r[name]) < float("inf") for r in rows.values())
        assert rows[1][name] == rows[2][name] == 0
    assert rows[4]["distinct_lines"] == 0.5 and rows[4]["distinct_words"] == 0.5
    assert rows[4]["bars"] == 2 / 17 and rows[4]["capitals"] == 2 / 17 and rows[4]["shouts"] == 2 / 17
    assert rows[5]["distinct_words"] == 1 / 40_000


def test_one_class_gives_a_constant(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "doc_id bigint, text string")
    stats = quality.with_statistics(docs)
    for rows, want in (([], 1 / 2), ([(1, 1), (1, 0), (None, 0), (7, 0), (2, None)], 2 / 3)):
        labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
        got = quality.with_score(stats, quality.fit(stats, labels, F.lit(True))).collect()
        assert [round(r["score"], 9) for r in got] == [round(want, 9)] * 3
        assert {r["predicted"] for r in got} == {1}
    empty = stats.where("false")
    assert quality.with_score(empty, quality.fit(empty, labels, F.lit(True))).collect() == []


def test_held_out_accuracy_and_compiled_rules(spark):
    """Learned on two thirds of the labels of sf0.1, judged on the rest; the plan runs no Python."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    stats = quality.with_statistics(docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi"))
    stats = stats.select("doc_id", *quality.STATISTICS).cache()
    model = quality.fit(stats, labels, id_crc() % 3 != 1)
    assert 1 < len(model.rules) < 200
    scored = quality.with_score(stats, model)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    held = scored.join(labels, "doc_id").where(id_crc() % 3 == 1).toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.97
    logit = held.apply(
        lambda r: model.bias + sum(x.weight for x in model.rules if all((r[n] > t) == above for n, above, t in x.conditions)), axis=1
    )
    assert ((logit >= 0) == (held["predicted"] == 1)).all()
