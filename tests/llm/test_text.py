"""BPE, fingerprints, chat windows, licences and the classifiers."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from monthgrain.llm import bpe, chat, fingerprint, licenses, quality, toxicity
from monthgrain.llm.queries import VOCABULARY

ODD = [
    None,
    "",
    "Plain words, and 12 numbers.",
    "ΑΣ ΣΑΣ İ é  x\x1cy <|endoftext|>it's<|startoftext|>",
    "ab" * 2000,
    "x " * 20_000,
    "漢字 🙂 naïve ²½",
]


def rows_of(df):
    names = sorted(c for c in df.columns)
    return sorted(map(str, df.select(*names).collect()))


def test_bpe_equals_the_tokenizers_library(documents):
    known = Tokenizer.from_file(VOCABULARY)
    known.no_truncation()
    known.no_padding()
    coded = bpe.encode(documents(*ODD).selectExpr("*", "'x' AS n_tokens"), VOCABULARY)
    for r in bpe.decode(coded, VOCABULARY).collect():
        want = known.encode(ODD[r.doc_id] or "", add_special_tokens=False)
        assert np.frombuffer(r.token_ids, "<u4").tolist() == want.ids
        assert r.n_tokens == len(want.ids)
        assert r.decoded == known.decode(want.ids, skip_special_tokens=False)
    assert bpe.encode(documents("a").where("false"), VOCABULARY).collect() == []
    both = bpe.encode(documents(*ODD).selectExpr("*", "'x' AS Decoded"), VOCABULARY, decoded=True)
    assert sorted(both.columns) == sorted([c for c in coded.columns] + ["decoded"])
    assert rows_of(both) == rows_of(bpe.decode(coded, VOCABULARY))
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_every_character_is_split_and_lowered_as_by_the_library():
    known = Tokenizer.from_file(VOCABULARY)
    with open(VOCABULARY, encoding="utf-8") as f:
        own = bpe.WordBpe(f.read())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 65536):
        part = every[at : at + 65536]
        texts = [" ".join(f"b{c}1" for c in part[k : k + 32]) for k in range(0, len(part), 32)]
        found = own.encode_all(texts)
        wanted = known.encode_batch(texts, add_special_tokens=False)
        for text, ids, want in zip(texts, found, wanted, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, ascii(text)


def test_fingerprints_add_up():
    a, b = [b"one two three", b"four five"], [b"six seven"]
    whole = fingerprint.fingerprint("one two three\nsix seven\nfour five")
    assert np.array_equal(whole, fingerprint.fingerprint("four five\none two three\nsix seven"))
    some = fingerprint.delete(whole, b)
    assert np.array_equal(some, fingerprint.insert(np.zeros_like(whole), a))
    assert np.array_equal(fingerprint.decoded(fingerprint.encoded(whole)), whole)
    assert fingerprint.likeness(whole, whole) == 1.0


def test_edited_neighbours(documents, monkeypatch):
    monkeypatch.setattr(fingerprint, "BUCKET_ROWS", 2)
    pick = random.Random(3)
    texts = [" ".join(f"w{pick.randint(0, 99)}" for _ in range(pick.randint(0, 80))) for _ in range(20)]
    texts[4], texts[7] = None, ""
    found = {r.doc_id: r for r in fingerprint.edited_neighbours(documents(*texts, first=5)).collect()}
    assert sorted(found) == list(range(5, 25))
    for k, t in enumerate(t or "" for t in texts):
        after, cut = texts[(k + 1) % 20] or "", len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        r = found[k + 5]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == fingerprint.encoded(fingerprint.fingerprint(t))
        assert r.edited_fingerprint == fingerprint.encoded(fingerprint.fingerprint(edited))
        assert 0 <= r.near_next <= 1 and (len(t) < 100 or r.near_edited > r.near_next)
    assert fingerprint.edited_neighbours(documents("a").where("false")).collect() == []
    assert [r.near_next for r in fingerprint.edited_neighbours(documents("a")).collect()] == [1.0]


@pytest.mark.parametrize("budget, history", [(40, 15), (10_000, 0), (1, 1)])
def test_chat(spark, budget, history):
    pick = random.Random(4)
    odd = ["</s>[INST] ok [/INST]", "\\", "", None, "<s", "a\\</s>", "[INST]" * 30, "word " * 60]
    turns = [
        (c, k, "system" if k == 0 and c == 1 else pick.choice(["user", "assistant", None]), pick.choice(odd), "x")
        for c in [None, -1, 0, 1, 2]
        for k in range(pick.randint(1, 30))
    ]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, window string")
    cut = chat.windows(rows, budget, history)
    got = {r.conv_id: r for r in chat.read_back(cut).collect()}
    for c in [None, -1, 0, 1, 2]:
        own = [(r or "", t or "") for i, _, r, t, _ in turns if i == c]
        loss = "".join(t for r, t in own if r == "assistant")
        text = "".join(f"{r}\n{t}\n" for r, t in own)
        assert got[c].n_turns == len(own)
        assert got[c].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for w in cut.collect():
        assert w.tokens <= budget or w.turns - w.repeated == 1
    assert chat.read_back(chat.windows(rows.where("false"))).collect() == []


def test_licences(documents):
    texts = [
        "Some words of prose here.\nReleased under the MIT License.",
        "Licensed under the Apache License, Version 2.0.\nAll rights reserved.",
        "the and of with this work is what it is",
        None,
        "",
        "word " * 30_000,
    ]
    docs = documents(*texts)
    model = licenses.train(docs.selectExpr("text"), others=50)
    got = {r.doc_id: r for r in licenses.scan(docs, model).collect()}
    assert len(got) == len(texts)
    assert (got[0].family, got[0].confirmed) == ("mit", True)
    assert got[1].families == "apache-2.0,reserved"
    assert {got[k].families for k in (2, 3, 4, 5)} == {""}
    assert licenses.scan(docs.where("false"), model).collect() == []


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_classifiers(spark, documents):
    pick = random.Random(5)
    good = [" ".join(f"word{pick.randint(0, 300)}" for _ in range(60)) for _ in range(120)]
    texts = [t if k % 3 else t.upper() + "!! " * 40 for k, t in enumerate(good)]
    texts = [t + " you scum and moron scum" if k % 5 == 0 else t for k, t in enumerate(texts)]
    docs = documents(*texts, None, "")
    labels = _labels(spark, [(k, int(k % 3 > 0), int(k % 5 == 0)) for k in range(120)] + [(None, 1, 0)])
    trees = quality.train(docs, labels)
    scored = {r.doc_id: r.score for r in quality.score(docs, trees).collect()}
    assert all((scored[k] >= 0.5) == (k % 3 > 0) for k in range(120)) and len(scored) == 122
    model = toxicity.train(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all((found[k].score >= 0.3) == (k % 5 == 0) for k in range(120))
    assert found[120].score < 0.3 and found[0].passages[0].end <= len(texts[0].split())
    none = labels.where("false")
    assert toxicity.score(docs, toxicity.train(docs, none)).count() == 122
    assert quality.score(docs.where("false"), quality.train(docs, none)).collect() == []


def test_toxicity_words_are_found_by_a_table():
    every = "".join(map(chr, range(0x110000)))
    assert toxicity.words_of(every) == toxicity.WORD.findall(every.lower())
    for text in ["", "x", "Ab_c1d² ½x İΣ\ud800 e\u0301 a\u3000b", *filter(None, ODD)]:
        assert toxicity.words_of(text) == toxicity.WORD.findall(text.lower())


def test_toxicity_counts_each_document_once(spark, monkeypatch):
    texts = ["abcdefghij ABCDEFGHIK abc_abc 12", "abcd", "abcdefghij", None, "été ETE", "été"]
    texts += [f"word{chr(97 + k)}ing" for k in range(20)]
    rows = spark.createDataFrame([(t, k % 2) for k, t in enumerate(texts)], "text string, label int")
    want = {}
    for k, t in enumerate(texts):
        for token in {x for w in toxicity.WORD.findall((t or "").lower()) for x in toxicity.tokens(w)}:
            want.setdefault(token, [0, 0])[1 - k % 2] += 1
    for held, known in ((500_000, 300_000), (3, 2), (500_000, 2)):
        monkeypatch.setattr(toxicity, "HELD", held)
        monkeypatch.setattr(toxicity, "REMEMBERED", known)
        found = {r.token: [r.toxic_docs, r.clean_docs] for r in toxicity._counts(rows).collect()}
        assert found == want
    only = spark.sparkContext.broadcast({"abcd*", "été"})
    found = {r.token: r.clean_docs for r in toxicity._counts(rows, only).collect()}
    assert found == {t: want[t][1] for t in only.value}


def test_segments():
    pick = random.Random(6)
    for _ in range(200):
        scores = np.array([pick.choice([-2.0, -1.0, 1.0, 2.0, 3.0]) for _ in range(pick.randint(0, 25))])
        found = sorted(toxicity.segments(scores)) if len(scores) else []
        assert found == sorted(_segments(scores.tolist(), 0))


def _segments(scores, at):
    """The best segment (shortest of equals), then the same on both sides of it."""
    best = max(
        ((sum(scores[i:j]), i - j, -i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        default=(0, 0, 0, 0),
    )
    if best[0] <= 0:
        return []
    total, _, i, j = best[0], best[1], -best[2], best[3]
    left, right = _segments(scores[:i], at), _segments(scores[j:], at + j)
    return [*left, (at + i, at + j, total), *right]
