"""The registered queries against their SQL or brute force over whole tables, and the pipeline's stages."""

import corpus_pipeline
import pytest
import test_minhash_dedup
import test_substring_dedup
from compare import connect, differences
from odd import documents, ordered

from claimloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(queries.queries()[name](spark, FOLDER), connect(FOLDER), queries.oracle_sql()[name]) is None


def test_whole_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.queries()["op7_substring_dedup"](spark, FOLDER).collect()
    assert ordered(got) == ordered(test_substring_dedup.brute(rows, 35))
    got = queries.queries()["op9_minhash_dedup"](spark, FOLDER).collect()
    assert ordered(got) == ordered(test_minhash_dedup.brute(rows, 85))


def test_one_query_per_operator():
    names = queries.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    given, count = docs.schema, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema.names == given.names and [f.dataType for f in out.schema] == [f.dataType for f in given], name
        assert 0 < out.count() <= docs.count() and (name != "substring_dedup" or out.count() == docs.count())
        docs = out
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.count() == docs.count() < count
    assert set(found.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_stages_take_odd_rows(spark):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() > 0, name
        empty = stage(spark, docs.limit(0), FOLDER)
        assert empty.count() == 0 and empty.columns == out.columns, name
