"""Exact dedup, line dedup, the n-gram join and components against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from monthgrain.llm import exact, jaccard, lines
from monthgrain.llm.components import connected_components


def test_exact(documents):
    texts = ["a", None, "", "b", "a", "a " * 50_000, "a", "A"]
    docs = documents(*texts).union(documents("b", first=3))
    found = {tuple(r) for r in exact.exact_duplicates(docs, bits=256).collect()}
    want = set()
    for i, t in enumerate(texts):
        same = [k for k, u in enumerate(texts) if (u or "") == (t or "")]
        n = len(same) + (t == "b")
        sha = hashlib.sha256((t or "").encode()).hexdigest()
        want.add((i, max(same), n, i == max(same), sha))
    assert found == want
    assert exact.exact_duplicates(docs).collect() != []
    assert exact.exact_duplicates(documents("a").where("false")).collect() == []


def _cut(texts):
    seen, out = set(), {}
    for i, t in sorted(texts.items()):
        own = (t or "").split("\n")
        full = [k for k, x in enumerate(own) if x.strip(" ")]
        gone = set()
        for k in range(len(full) - 2):
            key = tuple(own[j] for j in full[k : k + 3])
            if key in seen:
                gone |= set(full[k : k + 3])
            seen.add(key)
        kept = "\n".join(x for k, x in enumerate(own) if k not in gone)
        out[i] = (None if t is None else kept, len(full), len(gone))
    return out


def test_lines(documents):
    pick = random.Random(1)
    texts = ["\n".join(pick.choice("abc") + " x" for _ in range(pick.randint(1, 9))) for _ in range(40)]
    texts += [None, "", "a\n \nb\n\nc", "a\nb\nc\n", "q\n" * 3000]
    found = lines.drop_repeated_lines(documents(*texts))
    assert set(documents("a").columns) <= set(found.columns)
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in found.collect()}
    assert got == _cut(dict(enumerate(texts)))
    assert lines.drop_repeated_lines(documents("a").where("false")).collect() == []


def _sets(texts, size):
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = min(size, len(words))
        yield i, {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def _groups(texts, join):
    sets = dict(_sets(texts, join.size))
    near = {
        i: [
            j
            for j, b in sets.items()
            if i != j and a and join.den * len(a & b) >= join.num * len(a | b)
        ]
        for i, a in sets.items()
    }
    root = {i: i for i in sets}
    for _ in sets:
        root = {i: min([root[i], *(root[j] for j in near[i])]) for i in sets}
    return {i: (len(sets[i]), root[i], len(near[i])) for i in sets}


@pytest.mark.parametrize("tile, hot", [(1024, 100_000), (3, 1)])
def test_ngram_join(documents, tile, hot):
    pick = random.Random(2)
    base = [[f"w{pick.randint(0, 400)}" for _ in range(60)] for _ in range(4)]
    texts = [None, "", "one", "ONE\t", "two  words", " ".join(base[0]) + " "]
    for words in base:
        for _ in range(9):
            own = list(words)
            for _ in range(pick.randint(0, 3)):
                own[pick.randrange(60)] = "changed"
            texts += [" ".join(own), " ".join(own).upper()][: pick.randint(1, 2)]
    join = jaccard.Join(3, 80, 100)
    found = jaccard.jaccard_groups(documents(*texts), join, tile=tile, hot=hot).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in found}
    assert got == _groups(texts, join)


def test_ngram_join_of_nothing(documents):
    assert jaccard.jaccard_groups(documents("a").where("false")).collect() == []
    lost = documents("a b", "a b").selectExpr("cast(NULL AS long) AS doc_id", "text")
    assert [tuple(r) for r in jaccard.jaccard_groups(lost).collect()] == [(None, 1, None, 0)] * 2


def test_components(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 100), (7, 7), (90, 95)]
    found = connected_components(spark.createDataFrame(path, "u long, v long")).collect()
    got = {r.node: r.component for r in found}
    assert got == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}


def test_screen_keeps_every_link():
    """Short and long sets, with counts of one and of several bytes."""
    pick = np.random.default_rng(3)
    sets = []
    for n in (3, 60, 1000, 1100, 5000, 200_000):
        base = pick.integers(0, 1 << 63, n, dtype=np.uint64)
        for changed in (0, n // 40, n // 9, n // 2):
            own = base.copy()
            own[:changed] = pick.integers(0, 1 << 63, changed, dtype=np.uint64)
            sets.append(own)
    rows = [(*[None] * 6, jaccard._histogram(s)) for s in sets]
    allowed = np.triu(np.ones((len(sets), len(sets)), bool), 1)
    for join in (jaccard.Join(), jaccard.Join(3, 90, 100)):
        found = set(zip(*(k.tolist() for k in jaccard._bounded(rows, allowed, join)), strict=True))
        for i, j in zip(*np.nonzero(allowed), strict=True):
            both = len(np.intersect1d(sets[i], sets[j]))
            links = both * join.den >= join.num * (len(sets[i]) + len(sets[j]) - both)
            assert not links or (i, j) in found
        assert len(found) < allowed.sum()


def test_windows_are_made_once_for_each_text(documents):
    docs = documents("a\nb\nc\nd", "a\nb\nc")
    windows = lines._windows(docs.selectExpr("doc_id AS at", "text"), 3)
    plan = windows.select("at", "key")._jdf.queryExecution().executedPlan().toString()
    # no filter that makes all windows, and for each of them all lines, before they are spread
    assert plan.count("transform(sequence(") == 1


def test_only_texts_with_cuts_meet_them(documents, spark):
    docs = documents(*[f"text {k}" for k in range(300)])
    held = docs.selectExpr("struct(doc_id AS id) AS at", "struct(doc_id, text) AS row")
    cuts = spark.range(0, 300, 50).selectExpr("struct(id) AS at", "array(cast(id AS int)) AS cut")
    out = lines.with_cuts(held, cuts).collect()
    assert sorted((r["at"].id, r["row"].text, r["cut"]) for r in out) == [
        (k, f"text {k}", None if k % 50 else [k]) for k in range(300)
    ]
    none = lines.with_cuts(held, cuts.where("false")).collect()
    assert len(none) == 300 and all(r["cut"] is None for r in none)
