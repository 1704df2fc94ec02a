"""The pipeline's stages against brute force on small tables."""

import os

import pytest

import corpus_pipeline
from gamestate.llm import common, pii
from tests.llm.test_text_operators import ODD, brute, docs_of


def test_stages(spark, tiny):
    docs = common.table(spark, tiny, "documents")
    kept = corpus_pipeline.language_id(spark, docs, tiny)
    assert kept.columns == docs.columns
    clean = docs.where("length(text) > 40").count()
    kept = common.materialize(kept, "test")
    assert kept.where("length(text) > 40").count() == clean
    deduped = common.materialize(corpus_pipeline.near_dedup(spark, kept, tiny), "test")
    want = {i for i, (_, c) in brute([(r["doc_id"], r["text"] or "") for r in kept.collect()], 5, 80).items() if i == c}
    assert {r["doc_id"] for r in deduped.collect()} == want and sorted(deduped.columns) == sorted(docs.columns)
    masked = corpus_pipeline.pseudonyms(spark, deduped, tiny).collect()
    before = {r["doc_id"]: r["text"] for r in deduped.collect()}
    for r in masked:
        assert r["text"] == pii.pseudonymise(before[r["doc_id"]], corpus_pipeline.KEY)[0]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, tiny).collect()} == want


def test_the_session_names_the_key(spark, odd_docs):
    text = "mail jo@example.org"
    df = docs_of(spark, [(1, text)])
    spark.conf.set("spark.gamestate.pseudonymKey", "mine")
    try:
        assert corpus_pipeline.pseudonyms(spark, df, "").first()["text"] == pii.pseudonymise(text, b"mine")[0]
    finally:
        spark.conf.unset("spark.gamestate.pseudonymKey")


def odd_docs_of(spark):
    near = "the house and the river and the morning were with all of us when we came home from there and then it was good"
    rows = [*ODD, (50, near), (51, near + " so"), (51, "another text that has its own words and is not near to any of the others here"), (50, near), (60, "the other " + near)]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def odd_docs(spark):
    return odd_docs_of(spark)


def test_each_stage_on_odd_tables(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES:
        for df in (odd_docs, odd_docs.limit(0)):
            out = stage(spark, df, "")
            n = out.count()
            assert n == 0 if df is not odd_docs else n > 0
            if name != "packing":
                assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()


def test_texts_that_share_an_id_are_judged_one_by_one(spark, odd_docs):
    for df in (odd_docs, odd_docs.repartition(3), odd_docs.orderBy("text")):
        got = sorted((r["doc_id"] or -1, r["text"] or "") for r in corpus_pipeline.near_dedup(spark, df, "").collect())
        texts = [t for i, t in got if i in (50, 51, 60)]
        assert len(texts) == 2 and texts[0].startswith("the house") and texts[1].startswith("another text")
        assert [i for i, t in got if i in (50, 51, 60)] == [50, 51] and [i for i, _ in got].count(3) == 1
        assert (-1, "no id here") in got and (2**60 + 1, "") in got


def test_stage_tables_go(spark, odd_docs, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    common.clean(spark)
    corpus_pipeline.run(spark, str(tmp_path)).count()
    path = f"{common.shared_dir(spark)}/{spark.sparkContext.applicationId}".removeprefix("file:")
    assert {n.split("-")[0] for n in os.listdir(path)} <= {"document", "host", "pii", "kept"}
