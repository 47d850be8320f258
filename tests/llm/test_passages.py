"""Passage dedup against brute force, and as part of the pipeline's line dedup."""

import random
import re

import corpus_pipeline
from monthgrain.llm import passages


def _cut(texts):
    seen, out = set(), {}
    for i, t in sorted(texts.items()):
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
        gone = set()
        for k in range(len(words) - passages.RUN + 1):
            key = tuple(t[a:b].lower() for a, b in words[k : k + passages.RUN])
            if key in seen:
                gone |= set(range(k, k + passages.RUN))
            seen.add(key)
        out[i] = [t[a:b] for k, (a, b) in enumerate(words) if k not in gone]
    return out


def test_passages(documents):
    pick = random.Random(4)
    words = lambda n: [f"w{pick.randint(0, 10**6)}" for _ in range(n)]
    runs = [words(n) for n in (49, 50, 51, 80, 200)]
    texts = [None, "", "x " * 300, "short text"]
    for _ in range(30):
        own = [*words(pick.randint(0, 40)), *pick.choice(runs), *words(pick.randint(0, 40))]
        texts.append("".join(w + pick.choice([" ", " ", " ", "\n"]) for w in own))
    texts.append(texts[-1].upper())
    docs = documents(*texts)
    found = passages.drop_repeated_passages(docs)
    assert found.columns == docs.columns
    rows = {r.doc_id: r.text for r in found.collect()}
    assert rows[0] is None and len(rows) == len(texts)
    got = {i: (t or "").split() for i, t in rows.items()}
    assert got == _cut(dict(enumerate(texts)))
    assert any(len(got[i]) < len((t or "").split()) for i, t in enumerate(texts))
    assert passages.drop_repeated_passages(docs.where("false")).collect() == []


def test_line_feeds_stay():
    run = " ".join(["x"] * passages.RUN)
    assert passages.without(f"a\n{run}\nb".encode(), [0 + 1]) == b"a\n\nb"
    assert passages.without(f"a {run}  b".encode(), [1]) == b"a b"
    assert passages.without(run.encode(), [0]) == b""


def test_pipeline_cuts_passages_inside_lines(spark, documents, tmp_path):
    pick = random.Random(5)
    run = " ".join(f"w{pick.randint(0, 10**6)}" for _ in range(60))
    docs = documents(f"first {run} end", f"other {run} words")
    rows = corpus_pipeline.drop_lines(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id: r.text for r in rows} == {0: f"first {run} end", 1: "other words"}
    assert {r.doc_id: r.n_chars for r in rows}[1] == 11
