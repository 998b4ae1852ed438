"""The pipeline's stages one after the other, each judged on its own input, and the registered queries with SQL."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare_all import compare, duck
from tapweave.functions.stage import Stages
from tapweave.llm.common import table
from tapweave.llm.queries import ORACLES, QUERIES
from tests.llm.test_dedup import brute, brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_against_sql(spark, con, name):
    ok, note = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert ok, note


def test_stages(spark):
    docs = table(spark, SF, "documents").withColumns({"score": F.lit("s"), "digest": F.lit(None).cast("string")})
    seen = {}
    with Stages(spark) as stages:
        for name, apply in corpus_pipeline.STAGES:
            out = stages.write(apply(spark, docs, SF), name)
            if name != "packing":
                assert out.columns == docs.columns
                assert {r["score"] for r in out.select("score").distinct().collect()} == {"s"}
            before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
            after = {r["doc_id"] for r in out.select("doc_id").collect()}
            seen[name] = (before, after)
            docs = out

    before, after = seen["toxicity"]
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    gone = {d for d, _ in before} - after
    assert all(labels.get(d, 1) == 1 for d in gone)

    before, after = seen["exact_dedup"]
    assert after == {keep for _, keep, _ in brute(before)}

    before, after = seen["near_dedup"]
    assert after == {component for _, component in brute_components(before, 80).values()}

    before, after = seen["mixing"]
    assert after <= {d for d, _ in before} and after

    before, after = seen["packing"]
    assert after == {d for d, _ in before}


def test_run_gives_whole_sequences(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert len(out) and (out["offset"] + out["length"]).max() <= 1024
    assert not out.duplicated(["doc_id", "piece"]).any()


def test_mixing_meets_its_budget_whatever_the_rarest_cell(spark):
    docs = table(spark, SF, "documents")
    one = docs.limit(1).withColumns({"doc_id": F.lit(-1).cast(docs.schema["doc_id"].dataType), "source": F.lit("new"), "text": F.lit("rare " * 40)})
    docs = docs.unionByName(one.select(docs.columns))
    with Stages(spark) as stages:
        out = stages.write(corpus_pipeline.mixing.calibrated(docs, corpus_pipeline.MIX, stages), "mixed")
        kept = F.sum(F.col("mix_tokens") * F.col("mix_probability"))
        everything, expected = out.agg(F.sum("mix_tokens"), kept).first()
        assert expected == pytest.approx(corpus_pipeline.MIX.budget * everything, rel=1e-6)
        assert out.where("doc_id = -1").first()["mix_kept"]
        got = corpus_pipeline.mixed(spark, docs, SF)
        assert sorted(r[0] for r in got.select("doc_id").collect()) == sorted(r[0] for r in out.where("mix_kept").select("doc_id").collect())
