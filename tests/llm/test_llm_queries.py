"""The queries with SQL on the smallest tables, mixing, and the pipeline."""

import pytest

import corpus_pipeline
from checks.compare import _rows, duck
from monthgrain.llm import mixing
from monthgrain.llm.queries import DOMAIN, QUERIES, SQL, WEIGHTS

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck(FOLDER).execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())


def test_mixing_meets_its_budget(spark, documents):
    docs = documents(*["some words here"] * 30, None, "")
    rows = mixing.mix(docs, DOMAIN, WEIGHTS).collect()
    assert len(rows) == 32 and {r.copies for r in rows if r.text is None} == {0}
    assert abs(sum(r.copies * r.n_tokens for r in rows) - 54) <= 3 * 6
    assert mixing.mix(docs.where("false"), DOMAIN, WEIGHTS).collect() == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:4]:
        before = docs.count()
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0 < docs.count() <= before
    last = corpus_pipeline.run(spark, FOLDER)
    assert last.where("length(token_ids) <> 4 * n_tokens").count() == 0 and last.count() > 0
