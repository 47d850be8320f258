"""Resampling against sums over dictionaries."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from monthgrain.llm import resampling
from monthgrain.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NAMES = ("doc_id", "n_features", "weight", "score", "rank")


def grams(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [
        zlib.crc32(" ".join(words[k : k + n]).encode()) % 10000
        for n in (1, 2, 3)
        for k in range(len(words) - n + 1)
    ]


def brute(docs, target, least=20, percent=5):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(grams(text)[1])
    for text in target:
        t.update(grams(text)[1])
    ss, tt = s.total(), t.total()
    rows, eligible = [], []
    for doc_id, text in docs:
        words, own = grams(text)
        weight = sum(
            math.floor(1000 * math.log((t[f] + 1) * (ss + 10000) / ((s[f] + 1) * (tt + 10000))))
            for f in own
        )
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None])
        if len(words) >= least:
            eligible.append(rows[-1])
    for rank, row in enumerate(sorted(eligible, key=lambda r: (-r[3], r[0])), 1):
        if rank <= percent * len(eligible) // 100:
            row[4] = rank
    return sorted(map(tuple, rows))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = QUERIES["op13_resampling"](spark, folder)
    assert set(found.columns) == set(NAMES)
    assert sorted(tuple(r[c] for c in NAMES) for r in found.collect()) == brute(docs, target)


def test_odd_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(resampling, "_PIECE", 16)  # runs of words go on over pieces
    texts = ["", None, "Ünï-code 1st WORD [ok] a b c d e f g" * 9, "one two three " * 30, "one", "x" * 99]
    docs = documents(*texts)
    target = spark.createDataFrame([("one two three",), (None,)], "text string")
    rows = resampling.resample(docs, target, percent=50, least_words=1)
    assert {"kept", "lang"} <= set(rows.columns) and rows.schema["score"].dataType.typeName() == "long"
    want = brute(list(enumerate(texts)), ["one two three"], 1, 50)
    assert sorted(tuple(r[c] for c in NAMES) for r in rows.collect()) == want
    same = docs.where("doc_id = 3").drop("doc_id").selectExpr("CAST(NULL AS BIGINT) AS doc_id", "*")
    twice = resampling.resample(same.union(same), target, percent=50).collect()
    assert sorted(str(r["rank"]) for r in twice) == ["1", "None"]
    assert resampling.resample(docs.where("false"), target.where("false")).collect() == []
    alone = resampling.resample(docs, target.where("false")).collect()
    assert len(alone) == 6


def test_planes_add_up():
    draw = np.random.default_rng(2)
    counts = draw.integers(0, 9, (5, resampling.BUCKETS)) * (draw.random((5, resampling.BUCKETS)) < 0.1)
    gains = draw.integers(-9000, 9000, resampling.BUCKETS)
    assert (resampling.sliced_sums(counts, gains) == counts @ gains).all()
    assert resampling.sliced_sums(counts * 0, gains).tolist() == [0] * 5
