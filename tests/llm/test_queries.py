"""Registered queries against their SQL, and the pipeline stage by stage."""

import collections

import pytest
from oracle_check import compare, connect

import corpus_pipeline
from gaugeflow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF_DIR, name) == ""


#: Queries whose rows are not documents.
OTHERS = ("op2_top_k_search", "op11_phrase_collocations", "op12_conversation_repair")


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("op") and n not in OTHERS])
def test_one_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
    found = collections.Counter(
        r["doc_id"] for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect()
    )
    assert set(found) == ids
    assert name.startswith("op5") or set(found.values()) == {1}


def test_pipeline_keeps_clean_documents(docs, spark):
    long_ = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    table = docs(
        [long_, long_, long_ + " more", "entirely another text", "12 34", None,
         "login password=abcdefgh12345 here"],
    )
    kept = table
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF_DIR)
        assert after.columns == table.columns
        kept = spark.createDataFrame(after.collect(), table.schema)
        sizes.append({r["doc_id"] for r in kept.collect()})
    assert sizes == [{0, 1, 2, 3, 6}, {1, 2, 3, 6}, {1, 3, 6}, {1, 3, 6}]
    assert kept.filter("doc_id = 6").first()["text"] == "login [SECRET] here"
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    assert {p["doc_id"] for p in packed} == {1, 3, 6}
    assert len({p["sequence_id"] for p in packed}) == 1


def test_pipeline_of_nothing(no_docs, spark):
    kept = no_docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, kept, SF_DIR)
        assert kept.count() == 0


def test_pipeline_runs_over_the_table(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100
