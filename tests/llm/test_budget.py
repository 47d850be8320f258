"""The budget of mixing is named by its callers."""

import corpus_pipeline
from monthgrain.llm import mixing, queries


def test_budget_is_passed(spark, documents, monkeypatch):
    given = []
    real = mixing.mix
    monkeypatch.setattr(mixing, "mix", lambda *a, **k: given.append(a[3:]) or real(*a, **k))
    queries.op3_mixing(spark, "/root/testdata/sf0.001")
    corpus_pipeline.mix_sources(spark, documents("some words", "more words"), "")
    assert given == [(queries.BUDGET,)] * 2
