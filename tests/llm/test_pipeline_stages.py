"""Line dedup and the join of the pipeline against a plain reading of what each must do."""

import os
import random

import corpus_pipeline
from monthgrain.llm import filters, jaccard, lines, passages, scratch

DRAW = random.Random(11)
WORDS = ["".join(DRAW.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]


def prose(n):
    return " ".join(DRAW.choice(WORDS) for _ in range(n))


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near(a, b):
    x, y = shingles(a), shingles(b)
    return bool(x) and 100 * len(x & y) >= 80 * len(x | y)


def run_of_50(a, b):
    grams = [{tuple(t.split()[k : k + 50]) for k in range(len(t.split()) - 49)} for t in (a, b)]
    return bool(grams[0] & grams[1])


def given():
    passage = prose(60)
    base = prose(300)
    words = base.split()
    copy = " ".join([*words[:100], "other", *words[101:250], "word", *words[251:]])
    other = passage + " " + prose(100)
    return [
        base,  # 0
        copy,  # 1: near copy of 0, shares runs of 50 words with it
        base,  # 2: exact copy
        passage + " " + prose(80),  # 3: keeps the passage
        prose(50) + " " + passage + " " + prose(40),  # 4: loses it
        passage,  # 5: nothing is left
        other,  # 6: loses the passage
        " ".join([*other.split()[:150], "changed", *other.split()[151:]]),  # 7: near copy of 6, loses it too
        "   \n ",  # 8: nothing to train on
        "",  # 9
        None,  # 10
        "short text",  # 11
    ]


def test_stages_keep_and_drop_what_they_should(spark, documents):
    texts = given()
    docs = documents(*texts)
    cut = corpus_pipeline.drop_lines(spark, docs, "")
    assert cut.columns == docs.columns
    left = {r.doc_id: r.text for r in cut.collect()}
    # near copies are as alike as before, so the next stage sees them
    assert set(left) == {0, 1, 2, 3, 4, 6, 7, 11}
    assert [left[k] for k in (0, 1, 2, 3, 11)] == [texts[k] for k in (0, 1, 2, 3, 11)]
    passage = texts[5]
    assert all(passage not in left[k] for k in (4, 6, 7)) and near(left[6], left[7])
    kin = [{0, 1, 2}, {6, 7}]
    for a in left:
        for b in left:
            if a < b and not any({a, b} <= k for k in kin):
                assert not run_of_50(left[a], left[b])
    kept = corpus_pipeline.drop_near_copies(spark, cut, "")
    want = [k for k in sorted(left) if not any(near(left[j], left[k]) for j in left if j < k)]
    assert sorted(r.doc_id for r in kept.collect()) == want == [0, 3, 4, 6, 11]
    assert kept.columns == docs.columns


def test_kin_share_lines(documents):
    block = "one line\ntwo line\nthree line"
    docs = documents(block + "\nend", block, block).selectExpr("*", "doc_id div 2 AS kin")
    found = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs, kin_col="kin").collect()}
    assert found == {0: block + "\nend", 1: block, 2: ""}
    passage = prose(70)
    docs = documents(passage, passage, passage).selectExpr("*", "nullif(doc_id div 2, 1) AS kin")
    found = passages.drop_repeated_passages(docs, kin_col="kin").collect()
    assert {r.doc_id: r.text.strip() for r in found} == {0: passage, 1: passage, 2: ""}


def test_stages_on_odd_rows(spark, documents):
    none = documents("x").where("false")
    odd = documents(prose(60), "", None).selectExpr(
        "CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars", "kept AS KIN", "kept AS score"
    )
    for stage in (
        corpus_pipeline.drop_lines,
        corpus_pipeline.drop_near_copies,
        corpus_pipeline.mix_sources,
    ):
        assert stage(spark, none, "").collect() == []
        assert stage(spark, none, "").columns == none.columns
        assert stage(spark, odd, "").columns == odd.columns
    assert corpus_pipeline.drop_lines(spark, odd, "").count() == 1
    assert corpus_pipeline.drop_near_copies(spark, odd, "").count() == 3
    assert corpus_pipeline.encode(spark, none, "").collect() == []
    rows = corpus_pipeline.encode(spark, odd, "").collect()
    assert sorted(r.n_tokens for r in rows)[:2] == [0, 0] and len(rows) == 3


def test_few_texts_move_and_copies_go(spark, documents, monkeypatch):
    """Only near copies move to meet their group; of the texts between steps one copy is kept."""
    base = prose(200).split()
    copies = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in (20, 90, 150)]
    docs = documents(*[prose(150) for _ in range(60)], *copies)
    moved, there = [], []
    real, passage = filters.may_meet, passages.drop_repeated_passages

    def may_meet(rows, others, key):
        near, alone = real(rows, others, key)
        assert near.count() + alone.count() == rows.count()
        assert alone.join(others, key).isEmpty()
        moved.append((key, near.count()))
        return near, alone

    def cut(*args, **named):
        there.extend(n.split("-")[0] for n in os.listdir(scratch.folder(spark).removeprefix("file:")))
        return passage(*args, **named)

    before = {n.split("-")[0] for n in os.listdir(scratch.folder(spark).removeprefix("file:"))}
    for module in (jaccard, lines, corpus_pipeline):
        monkeypatch.setattr(module, "may_meet", may_meet)
    monkeypatch.setattr(passages, "drop_repeated_passages", cut)
    kin = corpus_pipeline._with_kin(docs, "kin").where("kin IS NOT NULL").collect()
    assert {(r.doc_id, r.kin) for r in kin} == {(60, 60), (61, 60), (62, 60)}
    left = {r.doc_id: r.text for r in corpus_pipeline.drop_lines(spark, docs, "").collect()}
    assert [left[60 + k] for k in range(3)] == copies and len(left) == 63
    assert {"id", "doc_id"} <= {key for key, _ in moved}
    assert all(3 <= n <= 10 for key, n in moved if key != "at")
    assert "lines" in there and ("kin" in before or "kin" not in there)
