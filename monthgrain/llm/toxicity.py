"""Toxicity: maximum-scoring segments over token log-odds.

Tokens are words and the beginnings of longer words. Every token of the labelled documents has its
log-odds of toxic against clean, with a Dirichlet prior in proportion to the counts of the tokens
in all documents, drawn towards zero by its standard error: rare tokens say little, whatever they
are. Words no sample has seen go by their longest beginning that it has. A linear scan gives every maximal segment of positive sum in a text; segments are
judged by extreme-value statistics of chance segments in clean text, and what is left of the
significant ones is turned into a probability.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthgrain.llm.labelled import labelled_sample
from monthgrain.llm.scratch import stored
from monthgrain.llm.words import in_slices

#: Most labelled documents used.
SAMPLE = 20_000
#: Lengths of word beginnings that are tokens, longest first.
BEGINNINGS = (7, 6, 5, 4)
#: Weight of the prior as a share of the sample, standard errors by which log-odds shrink towards
#: zero, what all scores are lowered by, significant E-value.
PRIOR, SHRINK, DRIFT, SIGNIFICANT = 0.05, 1.5, -0.5, 0.05
#: Token counts that a task holds before it passes them on, and words it remembers.
HELD, REMEMBERED = 500_000, 300_000

WORD = re.compile(r"[^\W\d_]+")
#: For ASCII: all but lower-case letters becomes a space.
_ASCII = {c: c if chr(c).islower() else 32 for c in range(128)}


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Each code point as it is where it belongs to words, else the space's."""
    found = np.full(sys.maxunicode + 1, 32, "<u4")
    for m in WORD.finditer("".join(map(chr, range(len(found))))):
        found[m.start() : m.end()] = np.arange(m.start(), m.end())
    return found


def words_of(text: str) -> list[str]:
    """All words of a text in lower case: what ``WORD`` finds, by a table of code points."""
    text = text.lower()
    if text.isascii():
        return text.translate(_ASCII).split()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _letters()[points].tobytes().decode("utf-32-le").split()


def tokens(word: str) -> list[str]:
    """A word and its beginnings (marked), longest first."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal segments (start, end, sum) of positive sum, in linear time.

    Candidates are kept on a stack with the running sums before and after them; a new one joins
    with the last candidate that starts lower and ends lower than it.
    """
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float]] = []
    linked: list[int] = []  # for each candidate, the nearest below it that starts lower
    for at in np.flatnonzero(scores > 0).tolist():
        start, low, high = at, float(sums[at]), float(sums[at + 1])
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= low:
                k = linked[k]
            if k < 0 or stack[k][3] >= high:
                stack.append((start, at + 1, low, high))
                linked.append(k)
                break
            start, low = stack[k][0], stack[k][2]
            del stack[k:], linked[k:]
    return [(s, e, high - low) for s, e, low, high in stack]


@dataclass
class Model:
    """Token scores and the calibration of segments."""

    scores: dict[str, float]
    rate: float = 1.0  # how fast chance segments become rare with their sum
    number: float = 1.0  # chance segments for each token, at sum 0
    shift: float = -2.0
    slope: float = 1.0
    seen: dict[str, float] = field(default_factory=dict, repr=False)

    def word(self, word: str) -> float:
        """The score of the longest token of a word that has one."""
        found = self.seen.get(word)
        if found is None:
            found = next((self.scores[t] for t in tokens(word) if t in self.scores), DRIFT)
            if len(self.seen) >= REMEMBERED:
                self.seen.clear()
            self.seen[word] = found
        return found

    def passages(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of words, and the maximal segments as (first word, end, sum)."""
        words = words_of(text)
        word, seen = self.word, self.seen
        scores = np.array([seen[w] if w in seen else word(w) for w in words], np.float64)
        return len(words), segments(scores) if len(words) else []

    def evidence(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Sum over significant passages of how far they exceed chance, and the passages."""
        n, found = self.passages(text)
        chance = np.log(max(self.number * max(n, 1), 1e-12))
        least = -np.log(SIGNIFICANT)
        judged = [(s, e, self.rate * total - chance) for s, e, total in found]
        toxic = [(s, e, x) for s, e, x in judged if x >= least]
        return float(sum(x for _, _, x in toxic)), toxic

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.shift + self.slope * np.log1p(evidence))))


class _Places(dict):
    """Where the tokens of a word stand: for each word the row of ``table`` with their numbers.

    Number 0 and row 0 are for no token. With ``only`` other tokens have no number.
    """

    def __init__(self, only: set[str] | None):
        self.only, self.number = only, {}
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.table, self.used = np.zeros((1 << 12, 1 + len(BEGINNINGS)), np.int32), 1

    def __missing__(self, word: str) -> int:
        only, number = self.only, self.number
        own = [
            number.setdefault(t, len(number) + 1) for t in tokens(word) if only is None or t in only
        ]
        row = 0
        if own:
            row, self.used = self.used, self.used + 1
            if row == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[row, : len(own)] = own
        self[word] = row
        return row


def _counts(rows: DataFrame, wanted=None) -> DataFrame:
    """(token, toxic_docs, clean_docs) over rows of (text, label).

    With ``wanted`` (a broadcast set) other tokens are not counted. Tasks sum what they see and
    pass it on when they hold many tokens; Spark adds up.
    """

    def flush(places: _Places, toxic: np.ndarray, clean: np.ndarray) -> pa.RecordBatch:
        names = pa.array(list(places.number), pa.string())
        columns = [pa.array(c[1 : len(names) + 1]) for c in (toxic, clean)]
        return pa.RecordBatch.from_arrays(
            [names, *columns], names=["token", "toxic_docs", "clean_docs"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Places(wanted.value if wanted is not None else None)
        held = np.zeros((2, 1 << 16), np.int64)
        for batch in in_slices(batches):
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = set(words_of(text or ""))
                at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
                while len(places.number) >= held.shape[1]:
                    held = np.concatenate([held, np.zeros_like(held)], 1)
                # a number that comes several times is raised once
                held[0 if label else 1, places.table[at].ravel()] += 1
                if len(places.number) > HELD:
                    yield flush(places, *held)
                    places.number.clear()
                    places.clear()
                    held = np.zeros_like(held)
                elif len(places) > REMEMBERED:
                    places.clear()
        yield flush(places, *held)

    kinds = "token string, toxic_docs long, clean_docs long"
    found = rows.select("text", "label").mapInArrow(run, kinds)
    return found.groupBy("token").agg(*[F.sum(c).alias(c) for c in found.columns[1:]])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE) -> Model:
    """Scores and calibration from at most ``bound`` labelled documents that are not held out,
    with the prior from all documents. Without toxic or clean rows every score is the same.
    """
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label, bound)
    numbers = sample.groupBy("label").agg(F.count("*").alias("n")).collect()
    totals = {bool(r["label"]): r["n"] for r in numbers}
    if len(totals) < 2:
        rate = (totals.get(True, 0) + 0.5) / (sum(totals.values()) + 1)
        return Model({}, shift=float(np.log(rate / (1 - rate))), slope=0.0)
    counts = stored(_counts(sample), "tokens")  # the tokens of a bounded sample
    names = counts.select("token").toArrow().column(0).to_pylist()
    wanted = spark.sparkContext.broadcast(set(names))
    del names
    texts = docs.select(F.col("text").cast("string").alias("text"), F.lit(0).alias("label"))
    corpus = _counts(texts, wanted).select("token", F.col("clean_docs").alias("docs"))
    # documents that have a token are counted, not its repeats within one
    weight = PRIOR * (totals[True] + totals[False])
    every = max(1, docs.count())
    shrunk = (
        counts.join(corpus, "token")
        .selectExpr(
            "token",
            f"toxic_docs + {weight}D * docs / {every} AS toxic",
            f"clean_docs + {weight}D * docs / {every} AS clean",
        )
        .selectExpr(
            "token",
            f"ln(toxic / ({totals[True]} + {weight}D - toxic + 1)) "
            f"- ln(clean / ({totals[False]} + {weight}D - clean + 1)) AS odds",
            f"{SHRINK}D * sqrt(1 / toxic + 1 / clean) AS error",
        )
        .where("abs(odds) > error")  # of the others nothing is left: words go by their beginnings
        .selectExpr("token", f"odds - sign(odds) * error + {DRIFT} AS score")
        .toArrow()
    )
    scores = dict(zip(shrunk.column(0).to_pylist(), map(float, shrunk.column(1).to_pylist()), strict=True))
    model = Model(scores)
    _calibrate(model, sample)
    return model


def _sample_passages(model: Model, sample: DataFrame) -> list:
    own = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [own.value.passages(t) for t in batch.column(0).to_pylist()]
            n = pa.array([n for n, _ in found], pa.int64())
            sums = pa.array([[x for *_, x in s] for _, s in found], pa.list_(pa.float64()))
            names = ["n", "sums", "label"]
            yield pa.RecordBatch.from_arrays([n, sums, batch.column(1)], names=names)

    rows = sample.select("text", "label").mapInArrow(run, "n long, sums array<double>, label int")
    return sorted(rows.collect(), key=str)


def _calibrate(model: Model, sample: DataFrame) -> None:
    """Fits chance segments to those of clean documents, then the probability to both kinds."""
    rows = _sample_passages(model, sample)
    clean = np.concatenate([[0.0], *(r.sums for r in rows if not r.label)])
    clean = clean[clean > 0]
    words = max(1, sum(r.n for r in rows if not r.label))
    # sums of chance segments beyond the least fall off exponentially
    least = float(np.quantile(clean, 0.5)) if len(clean) else 0.0
    beyond = clean[clean >= least] - least
    model.rate = float((len(beyond) + 2) / (beyond.sum() + 4))
    model.number = float((len(beyond) + 1) * np.exp(min(50.0, model.rate * least)) / words)
    judge = -np.log(SIGNIFICANT)
    x, y = [], []
    for r in rows:
        chance = np.log(max(model.number * max(r.n, 1), 1e-12))
        judged = model.rate * np.array(r.sums or [], np.float64) - chance
        x.append(np.log1p(judged[judged >= judge].sum()))
        y.append(float(r.label))
    model.shift, model.slope = _logistic(np.array(x), np.array(y))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Shift and slope by Newton's method, with a weak pull towards zero."""
    a = np.stack([np.ones_like(x), x], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ w))
        slope = a.T @ (y - p) - 0.01 * w
        curve = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(max(0.0, w[1]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and passages (first word, end, excess over chance).

    Null texts count as empty. Other columns pass through; ones named like these are replaced.
    """
    own = docs.sparkSession.sparkContext.broadcast(model)
    others = [c for c in docs.columns if c.lower() not in ("score", "passages")]
    at = others.index(text_col)
    given = docs.select(*[F.col(f"`{c}`") for c in others])
    passage = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("excess", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, 512) for k in range(0, whole.num_rows, 512)):
                found = [own.value.evidence(t or "") for t in batch.column(at).to_pylist()]
                scores = own.value.probability(np.array([x for x, _ in found]))
                passages = [
                    [{"start": s, "end": e, "excess": x} for s, e, x in p] for _, p in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(scores), pa.array(passages, pa.list_(passage))],
                    names=[*others, "score", "passages"],
                )

    spans = T.StructType().add("start", "long").add("end", "long").add("excess", "double")
    kinds = T.StructType(given.schema.fields[:]).add("score", "double")
    kinds = kinds.add("passages", T.ArrayType(spans))
    return given.mapInArrow(run, kinds)
